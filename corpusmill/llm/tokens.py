"""Token ids of a word-end BPE vocabulary, by the tokenizers library, with a bounded cache of word parts.

White space separates words for this tokenizer, so a text's ids are the joined ids of its words, and a plain word's those of
its parts: runs of letters, digits, runs of other signs.  Whole batches are cut into parts on their UTF-8 bytes; each
distinct part goes through the library's model once while the cache holds it, any other word through the whole tokenizer.
A vocabulary whose normalizer or pre-tokenizer is another gets each text through the whole tokenizer."""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import pyarrow as pa

from corpusmill.llm.common import cache, claim

END_ID = 2
SPACE, LETTERS, DIGIT, SIGNS, ODD = range(5)
# fixed values: the steps before the model that the cutting below stands for
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in own)}


def byte_kinds() -> np.ndarray:
    """Kind of each byte of UTF-8.  A word with an apostrophe, a bracket or bar of special tokens, or a letter beyond U+00FF
    is odd as a whole."""
    out = np.full(256, ODD, np.uint8)
    out[[32, *range(9, 14)]] = SPACE
    out[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), 0xC3]] = LETTERS
    out[48:58] = DIGIT
    out[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~>")] = SIGNS
    return out


_KINDS = byte_kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = bytes(np.flatnonzero((_KINDS != ODD) & (_KINDS != SPACE)).tolist())


class WordBpe(dict):
    """part or odd word, in UTF-8 -> its ids as little-endian unsigned 32-bit integers."""

    limit, stretch = 200_000, 4 << 20  # parts held, bytes of texts that are cut at once

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = False
        self.model = self.whole.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        self.letters = {ord(chr(b)): c for b, c in byte_letters().items()}
        spec = json.loads(self.whole.to_str())
        norm, pre = spec.get("normalizer") or {}, (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_parts = [x["type"] for x in norm.get("normalizers", [])] == NORMALIZERS and pre[0].get("pattern") == {"Regex": PIECES} and not spec.get("post_processor")
        vocab = self.whole.get_vocab()
        self.size = max(vocab.values()) + 1
        self.ends_sentence = np.zeros(self.size, bool)
        for token, i in vocab.items():
            if re.fullmatch(r".*[.!?]+[\"')\]]*</w>", token, re.DOTALL):
                self.ends_sentence[i] = True

    def whole_ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, part: bytes) -> bytes:
        if part.isascii() and not part.translate(None, _PLAIN):
            text = part.decode()
        elif not part.translate(None, _PLAIN) and b"\xc3\x97" not in part and b"\xc3\xb7" not in part:
            text = part.decode("latin-1").translate(self.letters)
        else:
            out = self[part] = self.whole_ids(part.decode("utf-8", "surrogatepass"))
            return out
        tokens = self.model.tokenize(text)
        out = self[part] = tokens[0].id.to_bytes(4, "little") if len(tokens) == 1 else array("I", [t.id for t in tokens]).tobytes()
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts, one text behind the other, without special tokens, and where each text ends.  Nulls are empty."""
        texts = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string()).fill_null("")
        if not self.by_parts:
            found = [self.whole_ids(t) if t else b"" for t in texts.to_pylist()]
            return np.frombuffer(b"".join(found), "<u4"), np.cumsum([len(x) >> 2 for x in found]).astype(np.int64)
        edges = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        out, stops, at, held = [], [], 0, 0
        while at < len(texts):  # stretches of texts, so that what is held besides the ids stays small
            to = max(at + 1, int(np.searchsorted(edges, edges[at] + self.stretch, side="right")) - 1)
            ids, ends = self._stretch(data[edges[at] : edges[to]], edges[at : to + 1] - edges[at])
            out.append(ids)
            stops.append(ends + held)
            at, held = to, held + len(ids)
        return np.concatenate(out) if out else np.empty(0, "<u4"), np.concatenate(stops) if stops else np.empty(0, np.int64)

    def _stretch(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, ends = self.parts(data, edges)
        if not len(parts):
            return np.empty(0, "<u4"), np.zeros(len(edges) - 1, np.int64)
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = list(map(self.__getitem__, distinct))
        if len(self) > self.limit:
            self.clear()
            self.update(zip(distinct, found, strict=True))
        flat, which = np.frombuffer(b"".join(found), "<u4"), coded.indices.to_numpy()
        n = np.fromiter(map(len, found), np.int32, len(found)) >> 2
        each = n[which]
        stop = np.cumsum(each)
        kind = np.int32 if stop[-1] < 1 << 31 else np.int64
        shift = (np.cumsum(n) - n).astype(kind)[which] - (stop - each).astype(kind)
        return flat[np.repeat(shift, each) + np.arange(stop[-1], dtype=kind)], np.r_[0, stop][ends]

    def parts(self, data: np.ndarray, edges: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """Parts of the texts that lie between edges, and where each text ends among them."""
        kind = _KINDS[data]
        low = _LOWER[data]
        first = np.zeros(len(data) + 1, bool)
        first[edges] = True
        first = first[:-1]
        if len(lead := np.flatnonzero(data == 0xC3)):
            after = data[lead + 1]
            upper = lead[(after < 0x9F) & (after != 0x97)] + 1
            low[upper] += 32
            sign = lead[(after == 0x97) | (after == 0xB7)]
            kind[sign] = ODD
        odd = np.flatnonzero(kind == ODD)
        if len(odd):
            # the words that hold them, from white space to white space or a text's edge
            word = np.flatnonzero(first | (kind == SPACE))
            i = np.unique(np.searchsorted(word, odd, side="right"))
            start, stop = np.r_[0, word][i], np.r_[word, len(data)][i]
            n = stop - start
            at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
            at = at[kind[at] != SPACE]
            kind[at], low[at] = ODD, data[at]
        begin = first.copy()
        begin[1:] |= kind[1:] != kind[:-1]
        begin |= kind == DIGIT
        solid = kind != SPACE
        begin &= solid
        offsets = np.flatnonzero(begin[solid])
        bytes_of = low[solid]
        where = np.searchsorted(np.flatnonzero(begin), edges[1:])
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets), [None, pa.py_buffer(np.r_[offsets, len(bytes_of)].astype(np.int64)), pa.py_buffer(bytes_of)]), where

    def encode(self, text: str | None) -> bytes:
        """ids of the whole text without special tokens; None counts as empty."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


def with_ends(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """ids with END_ID behind each text, and where each then ends."""
    out = np.empty(len(ids) + len(ends), "<u4")
    behind = ends + np.arange(len(ends))
    out[behind] = END_ID
    own = np.ones(len(out), bool)
    own[behind] = False
    out[own] = ids
    return out, behind + 1


_held: dict[str, WordBpe] = {}
cache("tokens", _held.clear)


def word_bpe(path: str, limit: int = WordBpe.limit, stretch: int = WordBpe.stretch) -> WordBpe:
    """One per Python worker; tasks that come later find the parts already known.  More of either is faster and takes more memory."""
    claim("tokens")
    if path not in _held:
        _held[path] = WordBpe(path)
    _held[path].limit, _held[path].stretch = limit, stretch
    return _held[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
