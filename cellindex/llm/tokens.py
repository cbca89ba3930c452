"""Token ids of whole texts from a public tokenizer file, with a bounded memo of chunks.

A tokenizer whose pre-tokens never reach over white space gives the same ids
whether it sees a text whole or cut there. Texts are therefore cut at blanks
and line feeds, every new chunk is encoded by the library once, and repeated
chunks come from a memo. What is cut is joined again without loss; the tests
compare this with the library on whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np

#: Ids are kept as little-endian unsigned 32-bit integers.
ID = np.dtype("<u4")
#: White space is no part of any token (``WORDS``), or opens the token that follows it (``LEADING``).
WORDS, LEADING = "words", "leading"

#: A mark after a letter or digit: no pre-token reaches over that place either. The apostrophe
#: (contractions) and the bar (special tokens) are left out, and of the letters those that
#: the tokenizer might turn into a letter and a mark.
_MARK = re.compile(r"[!-&(-/:-@\[-`{}~](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ].)")
_SPACE_STARTS = re.compile(r"[ \n](?<=\S.)|[!-&(-/:-@\[-`{}~](?<=[0-9A-Za-zÀ-ÖØ-öø-ÿ].)", re.S)
_LONGEST_KEPT = 48
_JOINED = 500


def _cut_words(text: str) -> list[str]:
    try:
        # In these characters lower case is one to one and nothing composes, so lowering
        # first, as the tokenizer does anyway, only makes the memo smaller.
        text.isascii() or text.encode("latin-1")
        text = text.lower()
    except UnicodeEncodeError:
        pass
    return _MARK.sub(r" \g<0>", text).replace("\n", " ").split(" ")


def _cut_leading(text: str) -> list[str]:
    # Mark the places with a character that no cut text may hold, then cut there.
    if "\x00" in text:
        return [text]
    return _SPACE_STARTS.sub("\x00\\g<0>", text).split("\x00")


class Encoder:
    """Encodes texts with one tokenizer file, without special tokens.

    ``cut`` says where white space goes in this tokenizer's pre-tokens, and
    ``memo`` how many chunks are remembered, which bounds the memory.
    """

    def __init__(self, path: str, cut: str = WORDS, memo: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker for each core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.cut = {WORDS: _cut_words, LEADING: _cut_leading}[cut]
        self.memo_size = memo
        self._ids: dict[str, bytes] = {}
        self._spans: dict[str, tuple[bytes, bytes]] = {}

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: empty) as little-endian bytes."""
        return [b"".join(x) for x in self._lookup(self._ids, texts, self._encode_ids)[1]]

    def spans(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """First character and end of every token of each text; needs the cut ``LEADING``, which keeps all places."""
        if self.cut is not _cut_leading:
            raise ValueError("spans need an encoder that cuts before white space")
        return list(map(self._place, *self._lookup(self._spans, texts, self._encode_spans)))

    def _lookup(self, memo: dict, texts: list[str | None], encode) -> tuple[list[list[str]], list[list]]:
        """The chunks of each text, and what the memo or the library has for each."""
        cut = [self.cut(t) if t else [] for t in texts]
        found = [list(map(memo.get, chunks)) for chunks in cut]
        gaps = [(n, k) for n, values in enumerate(found) if None in values for k, v in enumerate(values) if v is None]
        if gaps:
            new = list({cut[n][k] for n, k in gaps})
            once = dict(zip(new, encode(new)))
            for n, k in gaps:
                found[n][k] = once[cut[n][k]]
            if len(memo) + len(new) <= self.memo_size:
                memo.update((c, v) for c, v in once.items() if len(c) <= _LONGEST_KEPT)
        return cut, found

    def _encode_ids(self, chunks: list[str]) -> Iterable[bytes]:
        for ids, _ in self._encoded(chunks, spans=False):
            yield ids

    def _encode_spans(self, chunks: list[str]) -> Iterable[tuple[bytes, bytes]]:
        for _, span in self._encoded(chunks, spans=True):
            yield span[:, 0].tobytes(), span[:, 1].tobytes()

    def _encoded(self, chunks: list[str], spans: bool) -> Iterable[tuple[bytes, np.ndarray | None]]:
        """Ids and spans of each chunk; many go into one text for the library, which costs half as much."""
        lead = "" if self.cut is _cut_leading else " "
        fit = [bool(c) if lead else c[:1] == " " and c[-1:].isalpha() for c in chunks]
        together = [c for c, f in zip(chunks, fit) if f]
        joined = chain.from_iterable(
            self._split(together[i : i + _JOINED], lead, spans) for i in range(0, len(together), _JOINED)
        )
        for chunk, f in zip(chunks, fit):
            if f:
                yield next(joined)
            else:
                one = self.library.encode(chunk, add_special_tokens=False)
                yield np.array(one.ids, ID).tobytes(), _spans(one) if spans else None

    def _split(self, chunks: list[str], lead: str, spans: bool) -> Iterable[tuple[bytes, np.ndarray | None]]:
        whole = self.library.encode(lead.join(chunks), add_special_tokens=False)
        span, raw = _spans(whole), np.array(whole.ids, ID).tobytes()
        starts = np.cumsum([0] + [len(c) + len(lead) for c in chunks])
        at = np.searchsorted(span[:, 0], starts).tolist()
        for k, (a, b) in enumerate(zip(at, at[1:])):
            yield raw[4 * a : 4 * b], span[a:b] - starts[k] if spans else None

    def _place(self, chunks: list[str], pairs: list) -> tuple[np.ndarray, np.ndarray]:
        counts = np.array([len(a) for a, _ in pairs], np.int64) // 8
        widths = np.array([len(c) for c in chunks], np.int64)
        base = np.repeat(np.cumsum(widths) - widths, counts)
        start, end = (np.frombuffer(b"".join([p[k] for p in pairs]), np.int64) for k in (0, 1))
        return start + base, end + base


def _spans(x) -> np.ndarray:
    return np.array(x.offsets, np.int64).reshape(-1, 2)


@lru_cache(maxsize=2)
def encoder(path: str, cut: str = WORDS, memo: int = 600_000) -> Encoder:
    """One encoder for each worker process and tokenizer."""
    return Encoder(path, cut, memo)


def public_path(name: str) -> str:
    """Where the installed vocabulary files are; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)
