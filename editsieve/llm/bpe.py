"""Token ids of a public tokenizer, with one encoding per distinct piece of text.

A byte-level BPE never merges across the borders that its pre-tokenizer draws, and that
draws one before every single blank. So a text may be cut there, and the ids of the pieces
put together are the ids of the text. Pieces repeat: each worker keeps the ids of those it
has met (a bounded table) and gives the library only the new ones. Texts in which a cut could
matter (white space on both sides of a blank, or a special string) are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Pieces a worker remembers in each of two generations; about 200 bytes each.
REMEMBERED = 450_000
# Pieces encoded as the lines of one text.
LINES = 400
# Characters taken apart at a time.
SPAN = 500_000
_DOUBTFUL = re.compile(r"\s (?:\s|\Z)")
_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_STOPS = ".,;:!?"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file: stored counts belong to exactly this version."""
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceEncoder:
    """``ids(texts)``: the little-endian 32-bit ids of each text, as bytes."""

    _made: dict[str, PieceEncoder] = {}

    @classmethod
    def of(cls, path: str) -> PieceEncoder:
        """One per worker process, so that pieces are remembered from task to task."""
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.can_cut = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding")
            and not spec["model"].get("dropout")
        )
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.stops = frozenset(_STOPS)
        self.remembered = remembered
        self.after_blank: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.line_end = self.tok.encode("\n", add_special_tokens=False).ids if self.can_cut else []
        self.bare: dict[str, bytes] = {}

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words behind a blank, encoded as lines: a line end is a pre-token of its own before a blank."""
        out: list[bytes] = []
        groups = [words[i : i + LINES] for i in range(0, len(words), LINES)]
        for group, ids in zip(groups, self._encode(["\n".join(" " + w for w in g) for g in groups])):
            ends = (4 * np.flatnonzero(np.frombuffer(ids, dtype="<u4") == self.line_end[0])).tolist()
            if len(ends) + 1 != len(group):
                out += self._encode([" " + w for w in group])
                continue
            out += [ids[a:b] for a, b in zip([0, *(e + 4 for e in ends)], [*ends, len(ids)])]
        return out

    def _learn_bare(self, texts: set[str]) -> None:
        new = [t for t in texts if t not in self.bare]
        self.bare.update(zip(new, self._encode(new)))

    def _learn(self, pieces: set[str]) -> None:
        table = self.after_blank
        # A word and the stops behind it are two pre-tokens: the word alone is met more often.
        split = {}
        plain = set()
        for p in pieces:
            if p[-1:] in self.stops:
                word = p.rstrip(_STOPS)
                if word and word[-1].isalpha():
                    split[p] = (word, p[len(word):])
                    if word not in table:
                        plain.add(word)
                    continue
            plain.add(p)
        # Printable: no line end, tabulator or the like within.
        words = [p for p in plain if p and p.isprintable()]
        table.update(zip(words, self._encode_words(words)))
        other = list(plain.difference(words))
        table.update(zip(other, self._encode([" " + p for p in other])))
        self._learn_bare({stops for _, stops in split.values()})
        for p, (word, stops) in split.items():
            table[p] = table[word] + self.bare[stops]

    def stream(self, texts: pa.Array) -> Iterator[bytes]:
        """``ids`` of an Arrow column, row by row, with little of it as Python objects at a time."""
        group, size = [], 0
        for value in texts:
            text = value.as_py()
            if len(text) > SPAN:
                yield from self.ids(group)
                group, size = [], 0
                yield b"".join(self.ids([part])[0] for part in self._parts(text))
                continue
            group.append(text)
            size += len(text)
            if size > SPAN:
                yield from self.ids(group)
                group, size = [], 0
        yield from self.ids(group)

    def _parts(self, text: str) -> Iterator[str]:
        """A very long text, cut before blanks that stand alone; whole if it has a special string."""
        if not self.can_cut or any(s in text for s in self.special):
            yield text
            return
        at = 0
        while len(text) - at > SPAN and (cut := _SAFE_BLANK.search(text, at + SPAN)):
            yield text[at : cut.start()]
            at = cut.start()
        yield text[at:]

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        whole = [
            i for i, t in enumerate(texts)
            if not self.can_cut or _DOUBTFUL.search(t) or any(s in t for s in self.special)
        ]
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(whole, self._encode([texts[i] for i in whole]) if whole else []):
            out[i] = ids
        skip = set(whole)
        cut = {i: t.split(" ") for i, t in enumerate(texts) if i not in skip and t}
        if not cut:
            return out
        new = set().union(*cut.values()).difference(self.after_blank)
        if len(self.after_blank) + len(new) > self.remembered:
            # The table in use becomes the older one, from which pieces come back when they are met again.
            self.older, self.after_blank = self.after_blank, {}
            new = set().union(*cut.values())
        if self.older:
            back = [p for p in new if p in self.older]
            self.after_blank.update(zip(back, map(self.older.__getitem__, back)))
            new = new.difference(back)
        if len(self.bare) > self.remembered // 10:
            self.bare.clear()
        self._learn(new)
        self._learn_bare({p[0] for p in cut.values()})
        find = self.after_blank.__getitem__
        for i, pieces in cut.items():
            out[i] = self.bare[pieces[0]] + b"".join(map(find, pieces[1:]))
        return out
