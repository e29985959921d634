"""Token ids of whole texts with a public tokenizer file.

``Encoder.encode`` gives exactly the ids that the tokenizer gives for the whole
text. Both supported kinds (byte-level BPE, lower-case word BPE) never join
characters across a single space between two other characters, nor across a
letter and a following mark or single line end; texts are cut there and the
ids of the pieces are remembered in a table of bounded size. Any other white
space keeps its neighbours in one piece. The tokenizer's added tokens keep their
ids where a text holds them, as the library has it; such a text is not cut.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np

from .common import kept

_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARKS = ".,;:!?|"
_PART = re.compile(r"(?<=[^\W\d_])(?=[.,;:!?|]|\n\S)|(?<=[.,;:!?|])(?=\n\S)|(?<=\S\n)(?=\S)")


class _Known(dict):
    """Ids by piece; an unknown piece is noted and gives itself."""

    def __init__(self) -> None:
        self.new: set[str] = set()

    def __missing__(self, piece: str) -> str:
        self.new.add(piece)
        return piece

    def taken(self) -> set[str]:
        new, self.new = self.new, set()
        return new


class Encoder:
    """``encode(text)``: ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, limit: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content for t in added]
        norm = self.tokenizer.normalizer
        self.normalized = [norm.normalize_str(t.content) for t in added if t.normalized] if norm else []
        self.limit = limit
        self.spaced = _Known()  # pieces that follow a space
        self.bare: dict[str, bytes] = {}

    def _holds_added(self, text: str) -> bool:
        if any(x in text for x in self.added):
            return True
        return bool(self.normalized) and any(x in self.tokenizer.normalizer.normalize_str(text) for x in self.normalized)

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _words(self, words: list[str], between: str) -> list[bytes]:
        """Ids of words of letters with ``between`` (a space: also before the
        first): many in one call, told apart by the tokenizer's word numbers."""
        lines = [words[i:i + 64] for i in range(0, len(words), 64)]
        lead = between if between == " " else ""
        out = []
        for own, e in zip(lines, self.tokenizer.encode_batch([lead + between.join(x) for x in lines],
                                                             add_special_tokens=False)):
            number = np.array(e.word_ids, np.int64)
            ids = array("I", e.ids).tobytes()
            end = (np.cumsum(np.bincount(number)) * 4).tolist()
            start = [0, *end]
            if between != " " and len(end) == 2 * len(own) - 1:  # line ends are words of their own
                start, end = start[::2], end[::2]
            if len(end) == len(own):
                out += [ids[i:j] for i, j in zip(start, end)]
            else:  # some word is no single word to the tokenizer
                out += self._ids([lead + x for x in own])
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of pieces that follow a space or begin with a line end, seen for
        the first time; none for those that take part in a run of white space."""
        parts: dict[str, tuple[str, list[str]]] = {}  # a piece as one after a space and bare ones
        letters, others, bare_letters, bare_others = {}, {}, {}, {}
        spaced, bare = self.spaced, self.bare
        for w in words:
            if w.isalpha():
                letters[w] = None
                continue
            line, own = w[:1] == "\n", w.removeprefix("\n")
            if not own or own[0].isspace() or own[-1].isspace():
                continue
            if own.isalpha():
                lead, more = own, []
            elif own[-1] in _MARKS and own[:-1].isalpha():
                lead, more = own[:-1], [own[-1]]
            else:
                lead, *more = _PART.split(own)
            if line:
                lead, more = "", ["\n", lead, *more]
            parts[w] = lead, more
            if lead and lead not in spaced:
                (letters if lead.isalpha() else others)[lead] = None
            for x in more:
                if x not in bare:
                    (bare_letters if x.isalpha() else bare_others)[x] = None
        new = dict(zip(letters, self._words(list(letters), " ")))
        rest = dict(zip(bare_letters, self._words(list(bare_letters), "\n")))
        ids = self._ids([" " + x for x in others] + list(bare_others))
        new.update(zip(others, ids))
        rest.update(zip(bare_others, ids[len(others):]))
        for w, (lead, more) in parts.items():
            if more:
                first = b"" if not lead else new[lead] if lead in new else spaced[lead]
                new[w] = first + b"".join([rest[x] if x in rest else bare[x] for x in more])
        if len(spaced) < self.limit:
            spaced.update(new)
        if len(bare) < self.limit:
            bare.update(rest)
        return new

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode`` of each text; new pieces of some texts are learned at once."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > 300_000:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        ids_of = self.spaced.__getitem__
        firsts, found = [], []
        for t in texts:
            if self._holds_added(t):
                firsts.append(t)
                found.append(None)
                continue
            first, *pieces = t.replace("\n", " \n").split(" ")
            firsts.append(first)
            found.append(list(map(ids_of, pieces)))  # a new piece stands for itself
        new = self._learn(self.spaced.taken())
        for text, first, first_ids, ids in zip(texts, firsts, self._ids(firsts), found):
            if ids is None:  # a whole text
                yield first_ids
                continue
            try:
                if not first or first[-1].isspace():
                    raise KeyError
                yield first_ids + b"".join([x if x.__class__ is bytes else new[x] for x in ids])
            except KeyError:  # a run of white space
                lead, *rest = _CUT.split(text)
                yield b"".join(self._ids([lead] + [" " + x for x in rest])) if text else b""

    def encode(self, text: str) -> bytes:
        return next(self._group([text]))


def encoder(path: str, limit: int) -> Encoder:
    """The worker process's encoder for a file; its table outlives a task."""
    return kept(("encoder", path, limit), lambda: Encoder(path, limit))
