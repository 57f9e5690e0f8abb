"""Encoding whole texts with a public tokenizer file.

The tokenizers library defines the ids.  Most of its time goes into splitting
and keeping offsets, so two ways to the same ids come first:

* Texts of plain Latin characters are merged by tiktoken, from the vocabulary
  and merges of the same file.  That needs a vocabulary numbered in the order of
  its merges and one of the two splitting rules below; both are checked when the
  file is read.
* Of other texts, both rules split before merging, and no piece they merge spans
  a blank or line feed that stands alone between other characters.  So the ids
  of a text are those of its pieces one after the other, and a process can
  remember the ids of pieces it has met.

All else (white space in a row, other tokenizer files) is encoded as a whole.
"""

from __future__ import annotations

import re

import numpy as np

#: Pieces that a process remembers: this many recent ones, and as many older.
REMEMBERED = 250_000
#: Longer pieces are encoded each time.
LONGEST = 48
#: Pieces encoded in one call.
JOINED = 200

#: A blank or line feed, letters, and marks that no contraction begins with.
_WORD_AND_MARKS = re.compile(r"[ \n][A-Za-zÀ-ÖØ-öø-ÿ]+([.,;:!?*#$%&|]*)")
_PIECE = re.compile(r"[ \n]?[^ \n]+")
#: White space other than a blank or a line feed.
_OTHER_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


#: Texts that tiktoken may merge: byte-level files, and files with word ends.
_LATIN = re.compile("[\t\n\r -~¡-¬®-įı-ſ–—‘’“”…•€]*")
_LATIN_WORDS = re.compile("[\t\n\r -&(-~À-ÖØ-öø-ÿ]*")
#: Splitting rule of byte-level files, fixed by the tokenizers library, and
#: that of the file with word ends, as it stands there.
BYTE_RULE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The pieces of WORD_RULE in lower-case _LATIN_WORDS: letters, one digit, marks.
_PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\t\n\r ]+")


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    visible Latin-1 characters for themselves, the rest from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


def _merger(path: str):
    """A tiktoken encoding for a tokenizer file, and whether it marks word
    ends; None if the file's rules are others than those known here."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre, norm = file["model"], file["pre_tokenizer"] or {}, file["normalizer"]
    if model.get("type") != "BPE" or any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
        return None
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    merged = [a.replace(suffix, "") + suffix if suffix and a.endswith(suffix) else a for a in merged]
    first = 512 if suffix else 256
    if any(vocab.get(t) != first + i for i, t in enumerate(merged)):
        return None
    byte_level = {"type": "ByteLevel", "add_prefix_space": False}
    of = _byte_of()
    if not suffix:
        if norm is not None or any(pre.get(k) != v for k, v in {**byte_level, "use_regex": True}.items()):
            return None
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if i < first + len(merged)}
        return tiktoken.Encoding("file", pat_str=BYTE_RULE, mergeable_ranks=ranks, special_tokens={}), False
    steps, rules = (norm or {}).get("normalizers", []), pre.get("pretokenizers", [])
    if ([x["type"] for x in steps] != ["NFC", "Replace", "Lowercase"] or len(rules) != 2
            or steps[1].get("pattern") != {"Regex": r"\s+"} or steps[1].get("content") != " "
            or rules[0].get("pattern") != {"Regex": WORD_RULE} or not rules[0].get("invert")
            or any(rules[1].get(k) != v for k, v in {**byte_level, "use_regex": False}.items())):
        return None
    # a zero byte stands for the end of a word
    ranks = {}
    for t, i in vocab.items():
        if i < first + len(merged):
            ends = t.endswith(suffix)
            ranks[bytes(of[c] for c in (t[:-len(suffix)] if ends else t)) + (b"\0" if ends else b"")] = i
    return tiktoken.Encoding("file", pat_str="[^\\x00]+\\x00", mergeable_ranks=ranks, special_tokens={}), True


def _plain(text: str) -> bool:
    """Whether all white space is single blanks and line feeds inside the text."""
    return not (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n\n" in text
                or " \n" in text or "\n " in text or _OTHER_SPACE.search(text))


_encoders: dict[tuple[str, int], Encoder] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian integers, 16 bits each if the vocabulary
    (and the end id) fit, else 32; the end id is appended to each text."""

    def __init__(self, path: str, end_id: int):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True),
                   max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1, end_id + 1)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        self.end = np.array([end_id], self.dtype).tobytes()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.merger, self.ends_marked = _merger(path) or (None, False)
        # ids that end a word, or that begin with the blank or line feed before it
        self.cuts = np.zeros(size, dtype=bool)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.word_ends = any(t.endswith("</w>") for t in vocabulary)
        for t, i in vocabulary.items():
            self.cuts[i] = t.endswith("</w>") if self.word_ends else t[0] in "ĠĊ"

    def _merged(self, text: str) -> bytes | None:
        """Ids of a text that tiktoken can merge to the same ids."""
        if self.merger is None or "<|" in text:
            return None
        if self.ends_marked:
            if not _LATIN_WORDS.fullmatch(text):
                return None
            text = "".join([p + "\0" for p in _PIECES.findall(text.lower())])
            if not text:
                return b""
        elif not _LATIN.fullmatch(text):
            return None
        return self.merger.encode_to_numpy(text).astype(self.dtype).tobytes()

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in found]

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece.  Most begin with white space and are encoded end
        to end, many in one call; the ids tell where a piece ends: its first
        id begins with the white space, or so many of its ids end a word."""
        joined, words = [], []
        for p in pieces:
            if self.word_ends:
                m = _WORD_AND_MARKS.fullmatch(p)
                if m:
                    joined.append(p)
                    words.append(2 if m[1] else 1)
            elif p[0] in " \n" and "<" not in p:
                joined.append(p)
        rest = list(set(pieces).difference(joined))
        out = dict(zip(rest, self._whole(rest)))
        spans = range(0, len(joined), JOINED)
        found = self.tokenizer.encode_batch_fast(
            ["".join(joined[i:i + JOINED]) for i in spans], add_special_tokens=False)
        width = self.dtype.itemsize
        for i, e in zip(spans, found):
            ids = np.array(e.ids, self.dtype)
            at = np.flatnonzero(self.cuts[ids])
            if self.word_ends:
                ends = at[np.cumsum(words[i:i + JOINED]) - 1] + 1
            else:
                ends = np.append(at[1:], len(ids))
            flat, first = ids.tobytes(), 0
            for p, end in zip(joined[i:i + JOINED], (ends * width).tolist(), strict=True):
                out[p] = flat[first:end]
                first = end
        return out

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts (null: empty), each with the end id, packed."""
        done = [self._merged(t) if t else b"" for t in texts]
        texts = [t if d is None else None for t, d in zip(texts, done)]
        split = [_PIECE.findall(t) if t and _plain(t) else None for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known = self.known
        missing = set().union(*[s for s in split if s]).difference(known)
        again = missing.intersection(self.older)
        known.update((p, self.older[p]) for p in again)
        missing -= again
        if missing:
            known.update(self._pieces(list(missing)))
        whole = iter(self._whole([t for t, pieces in zip(texts, split) if t and pieces is None]))
        get = known.__getitem__
        out = [(b"".join(map(get, pieces)) if pieces else next(whole) if t else d) + self.end
               for t, pieces, d in zip(texts, split, done)]
        for p in [p for p in missing if len(p) > LONGEST]:
            del known[p]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]


def encoder(path: str, end_id: int) -> Encoder:
    """This process's encoder for a tokenizer file."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]
