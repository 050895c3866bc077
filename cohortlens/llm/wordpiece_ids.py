"""Token ids of the public word-BPE vocabulary, fast enough for whole corpora inside Arrow tasks.

The tokenizer's pre-tokeniser breaks at white space, so a text's ids are those of its stretches between blanks.
Plain stretches (printable, below U+0250, no special marker) are cut into pre-tokens by one substitution and
merged by a rank encoder built from the same merge list; any other chunk goes to the tokenizer itself. Ids are
those of ``encode(text, add_special_tokens=False)``.
"""

from __future__ import annotations

import json
import re
import unicodedata

import numpy as np

_END = "\x01"  # ends a pre-token; never part of a plain stretch
_ODD = re.compile("[^\x20-\x7e\n\xa1-\xac\xae-įı-ɏ]|<\\|")


def _kind(first: str) -> str:
    return re.escape("".join(c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == first))


_PRETOKEN = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_kind('L')}]+|[{_kind('N')}]|[^\\s{_kind('L')}{_kind('N')}]+")


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter; this maps the letter to the byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder of one vocabulary file."""

    def __init__(self, path: str):
        import tiktoken

        self.path, self._full = path, None
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, end = _byte_letters(), _END.encode()

        def raw(token: str) -> bytes:
            last = token.endswith("</w>")
            return bytes(letters[c] for c in (token[:-4] if last else token)) + (end if last else b"")

        # lowest ranks: the end mark joins the last byte of a pre-token before any merge of the list
        order = [bytes([b]) + end for b in range(256)] + [bytes([b]) for b in range(256)]
        seen = set(order)
        for merge in model["merges"]:
            token = raw("".join(merge) if isinstance(merge, list) else merge.replace(" ", ""))
            if token not in seen:
                seen.add(token)
                order.append(token)
        ids = {raw(t): i for t, i in model["vocab"].items()}
        self.ids = np.array([ids.get(t, -1) for t in order], np.int64)
        self.ranks = tiktoken.Encoding("word", pat_str="[^ ]+", mergeable_ranks={t: i for i, t in enumerate(order)},
                                       special_tokens={})

    @property
    def full(self):
        """The tokenizer itself, loaded when a chunk first needs it."""
        if self._full is None:
            from tokenizers import Tokenizer

            self._full = Tokenizer.from_file(self.path)
        return self._full

    def _plain(self, text: str) -> np.ndarray:
        marked = _PRETOKEN.sub("\\g<0>" + _END + " ", text.lower().replace("\n", " "))
        return self.ids[np.array(self.ranks.encode_ordinary(marked), np.int64)]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as uint32."""
        if not _ODD.search(text):
            got = self._plain(text)
        else:
            parts, run = [], []
            for chunk in text.replace("\n", " ").split(" "):
                if _ODD.search(chunk):
                    parts += [self._plain(" ".join(run)), np.array(self.full.encode(chunk, add_special_tokens=False).ids, np.int64)]
                    run = []
                else:
                    run.append(chunk)
            got = np.concatenate([*parts, self._plain(" ".join(run))])
        if got.size and got.min() < 0:  # a byte the merge list lacks: leave it to the tokenizer
            got = np.array(self.full.encode(text, add_special_tokens=False).ids, np.int64)
        return got.astype(np.uint32)


_OPEN: dict[str, WordBpe] = {}


def encoder(path: str) -> WordBpe:
    """One encoder per worker process and vocabulary."""
    if path not in _OPEN:
        _OPEN[path] = WordBpe(path)
    return _OPEN[path]
