"""Token ids of whole texts, batch by batch, by public tokenizers.

A chunk is what stands between two single spaces.  Both split patterns used here never look across such a space, so
chunks can be encoded on their own, each distinct one once per batch; texts in which a space touches other white
space are one chunk.  A bounded memo per Python worker keeps chunks between batches.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: Entries after which a worker's memo is emptied; bounds memory, never results.
MEMO_ENTRIES = 500_000
#: Bytes of text that are encoded at a time where :func:`slices` is used; the encoder's arrays are some twenty times that.
SLICE_BYTES = 4 << 20
#: Unicode white space by name, as the patterns' ``\s`` means it; RE2's ``\s`` is ASCII without ``\v``.
_SPACE = r"[\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
ODD_SPACE = rf" {_SPACE}|{_SPACE} |^{_SPACE}|{_SPACE}$"


def slices(batch, column: int, size: int = SLICE_BYTES):
    """A batch in slices of about ``size`` bytes in one of its columns, and of a row at least."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    bounds = [0, *(np.flatnonzero(np.diff(ends // size)) + 1).tolist(), len(batch)]
    for a, b in zip(bounds, bounds[1:]):
        yield batch.slice(a, b - a)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class ChunkEncoder:
    """Encodes Arrow columns of text; subclasses say what the ids of a chunk are."""

    def __init__(self, entries: int | None = None):
        self.memo: dict[str, bytes] = {}
        self.entries = entries or MEMO_ENTRIES

    def new_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk, as little-endian unsigned 32-bit integers.

        A chunk that begins with a space stood behind a single one in its text.
        """
        raise NotImplementedError

    def _known(self, chunks: list[str]) -> list[bytes]:
        memo = self.memo
        new = [c for c in chunks if c not in memo]
        if len(memo) + len(new) > self.entries:
            memo.clear()
            new = chunks
        memo.update(zip(new, self.new_chunks(new)))
        return [memo[c] for c in chunks]

    def encode(self, texts):
        """``(offsets, ids)`` of an Arrow string array without nulls.

        Text ``i`` has ``ids[offsets[i]:offsets[i + 1]]``.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        n = len(texts)
        texts = texts.cast(pa.large_string())
        odd = pc.match_substring_regex(texts, ODD_SPACE).to_numpy(zero_copy_only=False)
        spaced = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        parts = pc.split_pattern(spaced, " ")
        at = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        values = parts.flatten()
        later = np.ones(len(values), dtype=bool)
        later[at[:-1]] = False
        coded = values.filter(pa.array(later)).dictionary_encode()
        chunks = [" " + c for c in coded.dictionary.to_pylist()]
        index = np.empty(len(values), dtype=np.int64)
        index[later] = coded.indices.to_numpy()
        heads = texts.take(pa.array(np.flatnonzero(odd))).to_pylist() if odd.any() else []
        first = values.take(pa.array(at[:-1])).dictionary_encode()
        index[at[:-1]] = first.indices.to_numpy() + len(chunks)
        chunks += first.dictionary.to_pylist()
        if odd.any():
            index[at[:-1][odd]] = len(chunks) + np.arange(len(heads))
        found = self._known(chunks) + self.new_chunks(heads)
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        pool = np.frombuffer(b"".join(found), dtype="<u4")
        begin = np.cumsum(size) - size
        length = size[index]
        ends = np.cumsum(length)
        ids = pool[np.repeat(begin[index] - (ends - length), length) + np.arange(ends[-1] if n else 0)]
        return np.concatenate([[0], ends])[at], ids


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = r"!-&(-/:-@\[-`{-~"  # ASCII marks but the apostrophe, which can begin a clitic
#: Chunks of these characters are lower-cased letter by letter, lose their white space and split as below, so that the
#: merges can be asked directly; all others, and those that could name a special token, take the library's whole path.
_PLAIN = re.compile(rf"[{_LETTERS}0-9{_MARKS} \n\t]*\Z")
_PARTS = re.compile(rf"[{_LETTERS}]+|[0-9]|[{_MARKS}]+")


def _byte_letters() -> dict[int, str]:
    """The usual printable stand-ins of bytes in byte-level vocabularies: printable Latin-1 as is, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class WordEncoder(ChunkEncoder):
    """Ids by a ``tokenizers`` file that lower-cases words and drops white space."""

    def __init__(self, path: str, entries: int | None = None):
        super().__init__(entries)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.letters = _byte_letters()
        self.words: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def new_chunks(self, chunks: list[str]) -> list[bytes]:
        out, words = [], self.words
        if len(words) > self.entries:
            words.clear()
        for chunk in chunks:
            part = chunk[1:] if chunk.startswith(" ") else chunk
            if part.isascii() and part.isalpha():  # one word
                part = part.lower()
                ids = words.get(part)
                if ids is None:
                    ids = words[part] = self._word(part)
                out.append(ids)
            elif _PLAIN.match(chunk) and "<|" not in chunk:
                parts = []
                for part in _PARTS.findall(chunk.lower()):
                    ids = words.get(part)
                    if ids is None:
                        ids = words[part] = self._word(part)
                    parts.append(ids)
                out.append(parts[0] if len(parts) == 1 else b"".join(parts))
            else:
                out.append(array("I", self.tok.encode(chunk, add_special_tokens=False).ids).tobytes())
        return out


@lru_cache(maxsize=4)
def word_encoder(path: str, entries: int | None = None) -> WordEncoder:
    return WordEncoder(path, entries)
