"""Token ids of whole texts with a public tokenizer whose file path is a parameter."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space of the tokenizer's splitting rule (Unicode White_Space). Fixed values.
_SPACE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
_SPACE_POINTS += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_SPACE = "".join(map(chr, _SPACE_POINTS))

# A byte-level tokenizer never merges across the start of a white-space run, and the last blank of
# a run goes with the word behind it. These units can therefore be encoded one by one.
_UNIT = re.compile(
    rf"[ \n]?[^{_SPACE}]+|[{_SPACE}]+(?=[ \n][^{_SPACE}])|[{_SPACE}]+[^{_SPACE}]*"
)

# Texts whose every white space is one blank or one line break between two words split by blanks.
_UNEVEN = "[ \n][ \n]|^[ \n]|[ \n]$|[" + "".join(set(_SPACE) - set(" \n")) + "]"

END_ID = 0

# New words are encoded this many to a run, this many runs to a call.
RUN, RUNS = 100, 100


# Bytes that each of an encoder's two look-up tables may take, and what an entry takes beside its
# characters and ids. Longer units are encoded every time.
TABLE_BYTES, ENTRY_BYTES, UNIT_CHARACTERS = 1 << 28, 150, 256


class Table(dict):
    """Ids by unit, emptied when its entries would take more than ``limit`` bytes."""

    def __init__(self, limit: int, fixed: dict[str, bytes]):
        super().__init__(fixed)
        self._limit, self._fixed, self._taken = limit, fixed, 0

    def find(self, units: list[str]) -> list[bytes | None]:
        return list(map(self.get, units))

    def learn(self, units: list[str], ids: list[bytes]) -> None:
        """Keep units; more at a time than the table holds are not kept."""
        if units and max(map(len, units)) > UNIT_CHARACTERS:
            short = [(unit, one) for unit, one in zip(units, ids, strict=True) if len(unit) <= UNIT_CHARACTERS]
            units, ids = [unit for unit, _ in short], [one for _, one in short]
        taken = sum(map(len, units)) + sum(map(len, ids)) + ENTRY_BYTES * len(units)
        if self._taken + taken > self._limit:
            self.clear()
            self.update(self._fixed)
            self._taken = 0
        if taken <= self._limit:
            self.update(zip(units, ids, strict=True))
            self._taken += taken

    def size(self) -> int:
        """Bytes that the entries take."""
        return sum(len(unit) + len(ids) + ENTRY_BYTES for unit, ids in self.items() if unit not in self._fixed)


class Encoder:
    """Encodes texts; units met before are looked up instead of being encoded again.

    Each of the two look-up tables takes at most ``limit`` bytes.
    """

    def __init__(self, path: str, limit: int = TABLE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        # Literals of added tokens are cut out of a text before anything else is split.
        literals = [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._added = "|".join(map(re.escape, literals))
        vocabulary = self._tokenizer.get_vocab()
        top = max(vocabulary.values()) + 1
        self._kind = np.dtype("<u4" if top > 1 << 16 else "<u2")
        # In a byte-level vocabulary each character of a token's name stands for one byte.
        self._bytes = np.zeros(top, dtype=np.int64)
        for name, number in vocabulary.items():
            self._bytes[number] = len(name)
        self._words = Table(limit, {"": b"", "\n": self._ids("\n")})
        self._units = Table(limit, {})

    def _ids(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype=self._kind).tobytes()

    def _encode(self, words: list[str]) -> list[bytes]:
        """Encode words of even texts in long runs; the tokens' bytes show each word's share.

        A word follows a blank unless it starts with a line break.
        """
        out: list[bytes] = []
        for at in range(0, len(words), RUNS * RUN):
            part = words[at : at + RUNS * RUN]
            units = [word if word[0] == "\n" else " " + word for word in part]
            runs = ["".join(units[k : k + RUN]) for k in range(0, len(units), RUN)]
            encoded = self._tokenizer.encode_batch_fast(runs, add_special_tokens=False)
            ids = np.concatenate([np.array(run.ids, dtype=self._kind) for run in encoded])
            ends = np.cumsum(pc.binary_length(pa.array(units)).to_numpy(), dtype=np.int64)
            stops = np.searchsorted(np.cumsum(self._bytes[ids]), ends, side="right")
            raw, stops = ids.tobytes(), (stops * self._kind.itemsize).tolist()
            out += [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text of any form, without an end id, as unsigned integers.

        A text with the literal of an added token is encoded in one piece.
        """
        if self._added and re.search(self._added, text):
            return np.frombuffer(self._ids(text), dtype=self._kind)
        units = _UNIT.findall(text)
        different = list(set(units))
        known = dict(zip(different, self._units.find(different), strict=True))
        fresh = [unit for unit, ids in known.items() if ids is None]
        known.update((unit, self._ids(unit)) for unit in fresh)
        self._units.learn(fresh, [known[unit] for unit in fresh])
        return np.frombuffer(b"".join(map(known.__getitem__, units)), dtype=self._kind)

    def documents(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of every text as ``<u4``, closed by the end id; a null text is an empty one."""
        texts = pc.fill_null(texts, "")
        uneven = pc.match_substring_regex(texts, _UNEVEN).to_numpy(zero_copy_only=False)
        uneven &= pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0
        if self._added:
            uneven |= pc.match_substring_regex(texts, self._added).to_numpy(zero_copy_only=False)
        even = pc.if_else(pa.array(uneven), "", texts)
        out = self._even(even)
        for at in np.flatnonzero(uneven):
            body = self.encode(texts[int(at)].as_py())
            out[at] = np.append(body.astype("<u4"), np.uint32(END_ID))
        return out

    def _even(self, texts: pa.Array) -> list[np.ndarray]:
        """A line break put before each text makes its first word one like any other; the break is
        one id, and dropping it leaves room for the end id."""
        if not len(texts):
            return []
        broken = pc.replace_substring(pc.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        words = pc.split_pattern(broken, " ")
        coded = words.flatten().dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        table = self._words.find(different)
        which = coded.indices.to_numpy(zero_copy_only=False)
        new = [at for at, ids in enumerate(table) if ids is None]
        for at, ids in zip(new, self._encode([different[at] for at in new]), strict=True):
            table[at] = ids
        self._words.learn([different[at] for at in new], [table[at] for at in new])
        flat = np.frombuffer(b"".join(table), dtype=self._kind)
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // self._kind.itemsize
        starts = np.cumsum(sizes) - sizes
        held = sizes[which]
        ends = np.cumsum(held)
        ids = flat[np.repeat(starts[which] - ends + held, held) + np.arange(ends[-1])]
        bounds = np.asarray(words.offsets)[1:] - words.offsets[0].as_py() - 1
        stops = ends[bounds]
        out = np.empty(len(ids), dtype="<u4")
        out[:-1] = ids[1:]
        out[stops - 1] = END_ID
        return np.split(out, stops[:-1])


@functools.lru_cache(maxsize=1)
def encoder(path: str, limit: int = TABLE_BYTES) -> Encoder:
    """One encoder for each worker process; the last one used is kept."""
    return Encoder(path, limit)
