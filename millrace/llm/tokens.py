"""Token ids of whole texts under byte-level vocabularies, each distinct piece of text encoded once per worker."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import public_tokenizers
import regex

# No match of the pattern goes on from a visible character to a space, so texts can be cut there.
CUT = re.compile(r"(?<=\S) ")
UNSAFE = re.compile(r"\s ")


def pieces(text: str) -> list[str]:
    """Cuts before spaces, so that the pattern finds the same matches in the pieces as in the text."""
    parts = CUT.split(text) if UNSAFE.search(text) else text.split(" ")
    return [parts[0], *[" " + p for p in parts[1:]]]


class Recent:
    """Values by key, at most ``limit`` between calls: those that nothing asked for lately make room."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> set:
        """The keys without a value; the values of all others are in ``young`` from now on."""
        if len(self.young) > self.limit // 2:
            self.young, self.old = {}, self.young
        keys = keys.difference(self.young)
        found = keys.intersection(self.old)
        self.young.update((k, self.old[k]) for k in found)
        return keys - found


class PieceCache:
    """Ids of pieces as little-endian 32-bit words; ``encode`` gets the distinct matches that are not known yet.

    Pieces and matches are kept apart, since the same match stands in many pieces. At most ``limit`` matches and half as
    many pieces are kept between calls; what is asked for again after it made room is encoded again, which costs time
    and nothing else.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 1_000_000):
        self.encode, self.known, self.words = encode, Recent(limit // 2), Recent(limit)
        self.matches = regex.compile(public_tokenizers.PATTERN).findall

    def split(self, parts: list[str], joined: bool) -> tuple[list[str], list[int]]:
        """All matches in the pieces, and how many of them end with each piece; ``joined`` pieces are read as one text."""
        found = [self.matches("".join(parts))] if joined else list(map(self.matches, parts))
        flat = list(chain.from_iterable(found))
        ends, size = np.cumsum([len(w) for w in flat]), np.cumsum([len(p) for p in parts])
        return flat, np.searchsorted(ends, size, side="right").tolist()

    def look_up(self, texts: list[str]) -> list[list]:
        """Per text the values of its pieces without empty ones; a piece's value joins those of its matches."""
        cut = [c if c[0] else c[1:] for c in map(pieces, texts)]
        new = self.known.missing(set().union(*cut))
        if new:
            # A word of letters alone is one match, with a space before it or without.
            words = {p for p in new if p.isalpha() or p[:1] == " " and p[1:].isalpha()}
            # Pieces from a space to a visible character make a text that the pattern cuts like them.
            inner = [p for p in new - words if p[0] == " " and not p[-1].isspace()]
            outer = list(new.difference(words, inner))
            mixed = [(inner, *self.split(inner, True)), (outer, *self.split(outer, False))]
            todo = list(self.words.missing(words.union(*(found for _, found, _ in mixed))))
            value, known = self.words.young, self.known.young
            if todo:
                value.update(zip(todo, self.encode(todo)))
            known.update((p, value[p]) for p in words)
            for parts, found, ends in mixed:
                each = [value[w] for w in found]
                known.update((p, self.join(each[a:b])) for p, a, b in zip(parts, [0, *ends], ends))
        get = self.known.young.__getitem__
        return [list(map(get, c)) for c in cut]

    @staticmethod
    def join(values: list) -> bytes:
        return b"".join(values)


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes with: visible Latin-1 as itself, the others from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def tokenizer_encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """Encodes matches by the model of a ``tokenizers`` file with a byte-level BPE; no special tokens."""
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_file(path).model, byte_letters()

    def encode(words: list[str]) -> list[bytes]:
        written = (w.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters) for w in words)
        return [b"".join([t.id.to_bytes(4, "little") for t in model.tokenize(w)]) for w in written]

    return encode


class ByteBpe:
    """Ids of whole texts under a ``tokenizers`` file with a byte-level BPE, as its plain call gives them.

    ``special`` texts are cut at the file's added tokens, which have ids of their own; otherwise their strings are
    plain text. Where ids rise with the merges, merges are chosen by id, which the ``tiktoken`` library does on whole
    texts; runs of white space that are too long for its pattern go match by match, and other files by their own call.
    """

    def __init__(self, path: str, special: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        self.added = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()} if special else {}
        back = {c: b for b, c in byte_letters().items()}
        vocab = self.whole.get_vocab(with_added_tokens=False)
        every = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        self.bytes_of = {i: bytes(back[c] for c in t) for t, i in vocab.items() if t not in every}
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in told["model"]["merges"]]
        pre = told["pre_tokenizer"] or {}
        self.fast = None
        if (sorted(made) == made and set(range(256)) == {b[0] for b in self.bytes_of.values() if len(b) == 1}
                and not told["normalizer"] and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                and not pre.get("add_prefix_space") and not told["model"].get("ignore_merges")):
            ranks = {b: i for i, b in sorted(self.bytes_of.items())}  # common tokens near each other in memory
            # A table without any special string makes the library look for an empty one at every place.
            some = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()} or {"<|end|>": max(self.bytes_of) + 1}
            self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens=some)
            self.by_match = tokenizer_encoder(path)
            self.matches = regex.compile(public_tokenizers.PATTERN).findall
            self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def ids(self, text: str) -> np.ndarray:
        """The ids as unsigned 32-bit numbers."""
        if self.fast is None:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        try:
            return self.fast.encode_to_numpy(text, allowed_special=set(self.added), disallowed_special=())
        except ValueError:
            parts = self.cut.split(text) if self.cut else [text]
            data = [self.added[p].to_bytes(4, "little") if p in self.added else b"".join(self.by_match(self.matches(p))) for p in parts]
            return np.frombuffer(b"".join(data), dtype="<u4")
