"""Exact, cached tokenisation with the tokenizers library.

BPE never merges across a pre-token and no pre-token of the two public files
spans a step from non-space to space, so a text is cut into chunks
(leading space plus one word; a plain Latin word parts from the marks after it),
each distinct chunk is encoded by the library, and a text is the concatenation
of its chunks' ids. Texts that hold a
character on which Python and the library may disagree about white space go to
the library whole. The cache holds ids as little-endian uint32 bytes; when it
is full, further chunks are encoded anew each time, which only costs time.
"""

from __future__ import annotations

import re
from array import array

_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?=[.,;:!?*#$%&|]+(?:\s|$))"
SPACED = re.compile(rf"\s*{_WORD}|\s*\S+|\s+")
BARE = re.compile(rf"{_WORD}|\S+")
#: White space to Python but not to Unicode's White_Space property, or the reverse.
ODD = re.compile("[\x1c-\x1f\x85᠎​﻿]")
#: Texts with white space that is not single inner blanks or line ends are cut in Python instead.
IRREGULAR_SPACED = "[\x01\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]|[ \n][ \n]|^[ \n]|[ \n]$"
IRREGULAR_BARE = "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
CACHE = 500_000
MARKS = ".,;:!?*#$%&|"
#: Bytes of text handled at once.
SLICE = 7_000_000
_held: dict = {}


def default_path(name: str) -> str:
    """Place of a public tokenizer file; imported late, for the path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


class CachedTokenizer:
    """``encode(texts)`` gives each text's ids as bytes of little-endian uint32. None counts as ''."""

    def __init__(self, path: str, spaces_matter: bool):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.spaces_matter = spaces_matter
        self.cut = (SPACED if spaces_matter else BARE).findall
        self.ids: dict[str, bytes] = {}  # by chunk, for the path in Python
        self.pieces: dict[str, bytes] = {}  # by piece (a chunk without its blank), for the bulk path
        self.marks: dict[str, bytes] = {}  # by run of marks

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, straight from the library."""
        found = []
        for at in range(0, len(texts), 2000):
            found += [array("I", e.ids).tobytes() for e in self.model.encode_batch_fast(texts[at : at + 2000], add_special_tokens=False)]
        return found

    def _each(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, passed as the words of a few long inputs: half the cost of a call's result each."""
        import numpy as np

        groups, found = [chunks[at : at + 200] for at in range(0, len(chunks), 200)], []
        for at in range(0, len(groups), 100):
            part = groups[at : at + 100]
            for group, e in zip(part, self.model.encode_batch(part, is_pretokenized=True, add_special_tokens=False)):
                ids, own = array("I", e.ids).tobytes(), e.word_ids
                ends = np.cumsum(np.bincount(own, minlength=len(group)) * 4).tolist() if own else [0] * len(group)
                found += [ids[a:b] for a, b in zip([0, *ends[:-1]], ends)]
        return found

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces of the bulk path that the cache lacks.

        A run of MARKS after a letter is a pre-token of its own: such a piece is its word and the marks.
        """
        marked, plain, seen, tails = [], {}, self.pieces, {}
        for c in pieces:
            word = c.rstrip(MARKS)
            if len(word) < len(c) and word[-1:].isalpha() and word[-1] < "\u0100" and word[-1] not in "ªº":
                tail = c[len(word) :]
                marked.append((c, word, tail))
                if word not in seen:
                    plain[word] = None
                tails[tail] = None
            else:
                plain[c] = None
        words = list(plain)
        if self.spaces_matter:
            whole = [c[1:] if c[:1] == "\x01" else c if c[:1] == "\n" else " " + c for c in words]
        else:
            whole = words
        found = dict(zip(words, self._each(whole)))
        for tail in tails:
            tails[tail] = self.marks.get(tail) or self._plain([tail])[0]
            if len(self.marks) < 10_000:
                self.marks[tail] = tails[tail]
        for c, word, tail in marked:
            found[c] = (seen.get(word) or found[word]) + tails[tail]
        if len(seen) < CACHE:
            seen.update(found)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, chunk by chunk in Python."""
        out: list[bytes] = []
        for at in range(0, len(texts), 200):
            out += self._some([t or "" for t in texts[at : at + 200]])
        return out

    def batches(self, column) -> list[bytes]:
        """The same for an Arrow column of strings; regular texts are cut, coded and joined in bulk."""
        import pyarrow as pa
        import pyarrow.compute as pc

        column = pc.fill_null(column, "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        out: list[bytes] = []
        ends = pc.cumulative_sum(pc.binary_length(column).cast("int64")).to_numpy(zero_copy_only=False)
        at = 0
        while at < len(column):
            upto = max(at + 1, int(ends.searchsorted((ends[at - 1] if at else 0) + SLICE, "right")))
            out += self._bulk(column.slice(at, upto - at))
            at = upto
        return out

    def _bulk(self, texts) -> list[bytes]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        irregular = pc.match_substring_regex(texts, IRREGULAR_SPACED if self.spaces_matter else IRREGULAR_BARE).to_numpy(zero_copy_only=False)
        out: list[bytes | None] = [None] * len(texts)
        if irregular.any():
            where = np.flatnonzero(irregular)
            for i, ids in zip(where, self.encode(texts.take(pa.array(where)).to_pylist())):
                out[i] = ids
        where = np.flatnonzero(~irregular)
        if not len(where):
            return out
        texts = texts.take(pa.array(where))
        if self.spaces_matter:  # \x01 marks the first chunk, which has no space before it
            texts = pc.replace_substring(pc.binary_join_element_wise("\x01", texts, ""), "\n", " \n")
            pieces = pc.split_pattern(texts, " ")
        else:
            pieces = pc.ascii_split_whitespace(texts)
        coded = pieces.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        known = list(map(self.pieces.get, chunks))
        new = [c for c, k in zip(chunks, known) if k is None]
        if new:
            found = self._new(new)
            known = [found[c] if k is None else k for c, k in zip(chunks, known)]
        lengths = np.fromiter(map(len, known), np.int32, len(known)) // 4
        pool = np.frombuffer(b"".join(known), "<u4")
        starts = np.cumsum(lengths, dtype=np.int64) - lengths
        codes = coded.indices.to_numpy()
        each = lengths[codes]
        ends = np.cumsum(each, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        index = np.repeat((starts[codes] - (ends - each)).astype(np.int32), each) + np.arange(total, dtype=np.int32)
        ids = pool[index].tobytes()
        bounds = np.concatenate([[0], ends])[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()] * 4
        for i, a, b in zip(where.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            out[i] = ids[a:b]
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        odd = [ODD.search(t) is not None for t in texts]
        cut = [None if o else self.cut(t) for t, o in zip(texts, odd)]
        ids = self.ids
        new = list({c for chunks in cut if chunks for c in chunks if c not in ids})
        if new:
            got = zip(new, self._each(new))
            if len(ids) < CACHE:
                ids.update(got)
            else:
                ids = _Both(ids, dict(got))
        look = ids.__getitem__
        whole = iter(self._plain([t for t, o in zip(texts, odd) if o]) if any(odd) else ())
        return [next(whole) if chunks is None else b"".join(map(look, chunks)) for chunks in cut]


class _Both(dict):
    """A small mapping over a large one that is not copied."""

    def __init__(self, large: dict, small: dict):
        super().__init__(small)
        self.large = large

    def __missing__(self, key: str) -> bytes:
        return self.large[key]


def tokenizer(path: str, spaces_matter: bool) -> CachedTokenizer:
    """One tokenizer for each worker process and file; it takes the memory of other operators' caches."""
    from tessera.llm.base import claim

    claim("tokens", _held)
    if (path, spaces_matter) not in _held:
        _held[path, spaces_matter] = CachedTokenizer(path, spaces_matter)
    return _held[path, spaces_matter]
