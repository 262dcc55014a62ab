"""Byte-level BPE vocabulary files: tokens, merges and the split of texts into pre-tokens."""

from __future__ import annotations

import functools
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import regex
from tokenizers.pre_tokenizers import ByteLevel


def _byte_chars() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the rest, in order, for U+0100 onward."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file of the tokenizers library.

    token_bytes: bytes of each id. merges: (left id, right id, merged id) by rank.
    specials: text to id of tokens that are matched in the raw text first.
    """

    # Fixed value: the pre-token pattern that byte-level BPE files of this kind prescribe.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or model.get("ignore_merges") \
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        chars = _byte_chars()
        ids = {bytes(chars[c] for c in t): i for t, i in model["vocab"].items() if t not in self.specials}
        self.token_bytes: list[bytes] = [b""] * (1 + max([*ids.values(), *self.specials.values()]))
        for b, i in [*ids.items(), *((t.encode(), i) for t, i in self.specials.items())]:
            self.token_bytes[i] = b
        self.ids = ids
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        both = ((bytes(chars[c] for c in a), bytes(chars[c] for c in b)) for a, b in pairs)
        self.merges = [(ids[a], ids[b], ids[a + b]) for a, b in both]
        self._spaces = [c for c in regex.findall(r"\s", "".join(map(chr, range(0x110000)))) if c != " "]
        self._gaps = regex.compile(r"(?<=\S) (?=\S)").split
        self.byte_ids = [ids[bytes([b])] for b in range(256)]
        self._split = regex.compile(self.PATTERN).findall
        # letters and numbers of a later Unicode version than the tokenizers library's are neither, to it
        ask = ByteLevel(add_prefix_space=False).pre_tokenize_str
        late = [c for c in regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, range(0x110000))))
                if unicodedata.category(c) == "Cn" and len(ask(f"a{c}1")) == 3]
        late_class = "".join(f"\\U{ord(c):08x}" for c in late)
        self._late = re.compile(f"[{late_class}]") if late else None
        self._split_late = regex.compile(
            self.PATTERN.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{late_class}])")
            .replace(r" ?\p{L}+", rf" ?(?:(?![{late_class}])\p{{L}})+").replace(r" ?\p{N}+", rf" ?(?:(?![{late_class}])\p{{N}})+")
        ).findall if late else None
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") \
            if self.specials else None

    def _splitter(self, text: str) -> Callable[[str], list[str]]:
        try:
            text.encode("latin-1")  # the common case, told apart at memory speed
        except UnicodeEncodeError:
            if self._late is not None and self._late.search(text):
                return self._split_late
        return self._split

    def pretokens(self, text: str) -> list[str]:
        """Pre-tokens of a text in order; a special token's text is one of its own."""
        split = self._splitter(text)
        if self._special is None or not self._special.search(text):
            return split(text)
        parts = (([p] if p in self.specials else split(p)) for p in self._special.split(text) if p)
        return list(itertools.chain.from_iterable(parts))

    def units(self, text: str) -> list:
        """The text cut before each single space or line end between other characters.
        Pre-tokens never span such a cut, as a space goes with what follows it and a line
        end stands alone: a unit's pre-tokens are those of the text. A string stands for
        itself, with a space before it unless it starts with the line end; a 1-tuple for its
        string as it is (at the start, or a special token)."""
        if self._special is not None and self._special.search(text):
            parts = self._special.split(text)
            return list(itertools.chain.from_iterable([(p,)] if p in self.specials else self._units(p) for p in parts if p))
        return self._units(text)

    def _units(self, text: str) -> list:
        if not text:
            return []
        ends = text[0] + text[-1]
        spaces = [c for c in self._spaces if c in text]
        if " " in ends or "  " in text or any(c + " " in text or " " + c in text for c in spaces):
            units = self._gaps(text)
        elif "\n" in spaces and "\n" not in ends and not any(c + "\n" in text or "\n" + c in text for c in spaces):
            units = text.replace("\n", " \n").split(" ")
        else:
            units = text.split(" ")
        units[0] = (units[0],)
        return units

    def unit_text(self, unit: str | tuple[str]) -> str:
        return unit[0] if isinstance(unit, tuple) else unit if unit[:1] == "\n" else " " + unit

    def unit_pretokens(self, unit: str | tuple[str]) -> list[str]:
        text = self.unit_text(unit)
        if text[1:].isalpha() and text[0] == " " and text.isascii():  # the common case: one word
            return [text]
        return [text] if text in self.specials else self._splitter(text)(text)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each Python worker."""
    return Vocabulary(path)


class Memo(dict):
    """Results by unit or pre-token, of bounded size: when it is full, it becomes the older half, and
    what is used again comes back from there; twice ``entries`` are held at most."""

    def __init__(self, fill: Callable[[list], Iterable], entries: int):
        super().__init__()
        self.fill, self.entries, self.older = fill, entries, {}

    def cover(self, texts: Iterable[list]) -> None:
        """Make sure that everything in a slice of cut texts has its result."""
        seen = set().union(*texts)
        unseen = [p for p in seen if p not in self]
        if len(self) + len(unseen) > self.entries:
            self.older = dict(self)
            self.clear()
            unseen = list(seen)
        if self.older:
            older = self.older
            self.update([(p, older[p]) for p in unseen if p in older])
            unseen = [p for p in unseen if p not in older]
        if unseen:
            self.update(zip(unseen, self.fill(unseen), strict=True))


def memo_of_units(voc: Vocabulary, of_pretokens: Memo, combine: Callable[[Iterable], object], entries: int, rows: int = 4096) -> Memo:
    """Results of units, combined from those of their pre-tokens."""
    def fill(units: list):
        for at in range(0, len(units), rows):
            split = [voc.unit_pretokens(u) for u in units[at:at + rows]]
            of_pretokens.cover(split)
            for s in split:
                yield combine(map(of_pretokens.__getitem__, s))
    return Memo(fill, entries)
