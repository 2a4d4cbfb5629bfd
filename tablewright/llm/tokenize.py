"""Exact, cached encoding with the public tokenizer libraries.

Encoding a chunk of text that the tokenizer's own pre-tokenizer never joins with its neighbours
gives the same ids wherever the chunk stands. So a text is cut at such places, each distinct
chunk is encoded once by the library, and the ids are put together from a dictionary of bounded
size. Where a text holds anything that makes a cut doubtful, the library encodes it whole.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from array import array
from collections.abc import Callable
from pathlib import Path

#: Entries of a generation of the dictionary of chunks, about 200 bytes each.
CHUNK_LIMIT = 300_000
#: A chunk over this length, such as a whole text, is not kept.
LONG_CHUNK = 64

#: Python's split() cuts at these, the library's expression does not.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"
#: The byte-level rules are cut only where all white space is blanks and line feeds, and no marker can start.
_UNSURE = ("<|", *"\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000", *map(chr, range(0x2000, 0x200B)))
_BYTE_CHUNKS = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]+")


def _word_chunks(text: str) -> list[str]:
    for c in _NOT_SPACE:
        if c in text:
            return [text]
    return text.split()


def _byte_chunks(text: str) -> list[str]:
    for c in _UNSURE:
        if c in text:
            return [text]
    return _BYTE_CHUNKS.findall(text)


#: White space that is more than one blank or line feed between words.
_RUNS = ("  ", "\n\n", " \n", "\n ")


def _byte_words(text: str) -> list[str] | None:
    """Words of plain running text, or None. All but the first stand for themselves after a blank, those that begin
    with a line feed for the line feed and the word: so no chunk has to be copied out with its blank."""
    for c in (*_RUNS, *_UNSURE):
        if c in text:
            return None
    return text.replace("\n", " \n").split(" ")


#: A letter before a last full stop or comma: the expressions of both kinds always cut there.
_MARKED = re.compile(r"[a-zA-Z\u00e0-\u00f6\u00f8-\u00ff][.,]\Z")
#: Up to here lower case is letter by letter and canonical composition changes nothing.
_PLAIN = re.compile(r"[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+\Z")


def _byte_stem(chunk: str) -> tuple[str, str] | None:
    return (chunk[:-1], chunk[-1]) if _MARKED.search(chunk[-2:]) and "<|" not in chunk else None


def _word_stem(chunk: str) -> tuple[str, str] | None:
    if "<|" in chunk or not _PLAIN.match(chunk):
        return None
    low = chunk.lower()
    if _MARKED.search(low[-2:]):
        return low[:-1], low[-1]
    return (low, "") if low != chunk else None


def _whole(text: str) -> list[str]:
    return [text]


def version_digest(path: str) -> str:
    """Hex digest of the vocabulary file, its kind and the library's version."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    h = hashlib.sha256(Path(path).read_bytes())
    h.update(f"|{Path(path).suffix}|{library.__name__}|{library.__version__}".encode())
    return h.hexdigest()


class _Chunks(dict):
    """Chunk -> value, encoded when first asked for. Two generations of at most `limit` entries: what is
    still in use moves to the young one before the old one is dropped."""

    def __init__(self, encode: Callable, value: Callable, stem: Callable | None, limit: int):
        self.encode, self.value, self.stem, self.limit, self.old = encode, value, stem, limit, {}

    def made(self, chunk: str):
        cut = self.stem(chunk) if self.stem else None
        return self[cut[0]] + self[cut[1]] if cut else self.value(self.encode(chunk))

    def __missing__(self, chunk: str):
        v = self.old.get(chunk)
        if v is None:
            v = self.made(chunk)
        if len(chunk) <= LONG_CHUNK:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[chunk] = v
        return v


class _Words(_Chunks):
    """Word -> value of a blank and the word; a word after a line feed goes to the chunks as it is."""

    def __init__(self, chunks: _Chunks, limit: int):
        super().__init__(chunks.encode, chunks.value, None, limit)
        self.chunks = chunks

    def made(self, word: str):
        if word.startswith("\n"):
            return self.chunks["\n"] + self.chunks[word[1:]] if len(word) > 1 else self.chunks["\n"]
        if _MARKED.search(word[-2:]):
            return self[word[:-1]] + self.chunks[word[-1]]
        return self.value(self.encode(" " + word))


class Encoder:
    """ids() gives each text's ids as little-endian unsigned 32-bit bytes, counts() their number."""

    def __init__(self, path: str, limit: int = CHUNK_LIMIT):
        stem = None
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.vocabulary = sp.vocab_size()
            encode, self._cut = (lambda text: sp.encode(text, num_threads=1)), _whole
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import json

            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            self.vocabulary = t.get_vocab_size(with_added_tokens=True)
            self._cut, stem, one_piece = _cutter(json.loads(Path(path).read_text()))
            encode = _encoding(t, one_piece)
        self._ids = _Chunks(encode, lambda ids: array("I", ids).tobytes(), stem, limit)
        self._counts = _Chunks(encode, len, stem, limit)
        self._words = _byte_words if self._cut is _byte_chunks else None
        self._word_ids, self._word_counts = _Words(self._ids, limit), _Words(self._counts, limit)

    def _each(self, texts: list[str], chunks: _Chunks, words: _Words, put_together: Callable) -> list:
        get, get_word, cut, running, out = chunks.__getitem__, words.__getitem__, self._cut, self._words, []
        for t in texts:
            found = running(t) if running else None
            if found is None:
                out.append(put_together(map(get, cut(t))))
            else:
                first = found[0]
                found[0] = ""
                rest = map(get_word, found)
                next(rest)
                out.append((put_together(map(get, (first,))) if first else put_together(())) + put_together(rest))
        return out

    def ids(self, texts: list[str]) -> list[bytes]:
        return self._each(texts, self._ids, self._word_ids, b"".join)

    def counts(self, texts: list[str]) -> list[int]:
        return self._each(texts, self._counts, self._word_counts, sum)


def _byte_letters() -> dict[int, str]:
    """The byte-level rules write each byte as a letter: printable ones as they are, the others as those from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _encoding(tokenizer, one_piece: re.Pattern | None) -> Callable[[str], list[int]]:
    """A chunk that the rules leave whole goes straight to the library's merges."""
    merge, letters = tokenizer.model.tokenize, _byte_letters()

    def encode(text: str) -> list[int]:
        if one_piece and one_piece.match(text):
            if text.isascii():  # of these only the blank is written otherwise
                return [t.id for t in merge(text.replace(" ", letters[32]))]
            return [t.id for t in merge(text.encode().decode("latin-1").translate(letters))]
        return tokenizer.encode(text, add_special_tokens=False).ids

    return encode


#: Runs of letters that are one piece for the rules: as they are after an optional blank, or in lower case.
_BYTE_PIECE = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+\Z")
_WORD_PIECE = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+\Z")


def _cutter(rules: dict) -> tuple[Callable[[str], list[str]], Callable | None, re.Pattern | None]:
    """Which cuts are safe follows from the file's rules; unknown rules mean none."""
    pre = rules.get("pre_tokenizer") or {}
    steps = pre.get("pretokenizers", [pre])
    kinds = [s.get("type") for s in steps]
    odd = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in rules.get("added_tokens", []))
    if odd or rules.get("truncation") or rules.get("padding") or rules.get("post_processor"):
        return _whole, None, None
    if kinds == ["ByteLevel"] and steps[0].get("use_regex") and not steps[0].get("add_prefix_space") and not rules.get("normalizer"):
        marked = all(t["content"].startswith("<|") for t in rules.get("added_tokens", []))
        return (_byte_chunks, _byte_stem, _BYTE_PIECE) if marked else (_whole, None, None)
    drops_space = (
        kinds == ["Split", "ByteLevel"]
        and steps[0].get("behavior") == "Removed"
        and steps[0].get("invert")
        and steps[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not steps[1].get("add_prefix_space")
        and not steps[1].get("use_regex")
    )
    names = [n.get("type") for n in (rules.get("normalizer") or {}).get("normalizers", [])]
    marked = all(t["content"].startswith("<|") for t in rules.get("added_tokens", []))
    safe = drops_space and marked and names == ["NFC", "Replace", "Lowercase"]
    return (_word_chunks, _word_stem, _WORD_PIECE) if safe else (_whole, None, None)


@functools.lru_cache(maxsize=4)
def encoder(path: str, limit: int = CHUNK_LIMIT) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path, limit)
