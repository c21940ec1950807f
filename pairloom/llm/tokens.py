"""Token ids of whole texts by a tokenizer file, with frequent words looked up."""

import functools
import json
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import tiktoken
from tokenizers import Tokenizer

_ODD = re.compile(r"[ \n]\s")
_WORD = re.compile(r" ?[\w.,;:!?'()\"-]+")
# A word that ends in one of these, after a letter, is split in front of it.
_ENDS = frozenset(".,;:!?")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """Content of a file of the installed public tokenizers; the driver reads it and sends it along."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


# Fixed value: how byte-level tokenizers of this kind split a text.
SPLITS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Bytes of texts whose letters, digits and white space all libraries agree on: ASCII without control characters, Latin, Greek
# and Cyrillic letters. The signs between U+2010 and U+203F but for white space, and the euro sign, are tested apart.
_KNOWN = bytes([9, 10, 13, *range(32, 127), *range(0x80, 0xC0), *range(0xC2, 0xC9), 0xCE, 0xCF, 0xD0, 0xD1, 0xE2])
_UNKNOWN_SIGN = re.compile(rb"\xe2(?!\x80[\x90-\xa7\xb0-\xbf]|\x82\xac)|\xc2[\x80-\xa0]")
_WHITE = bytes.maketrans(b"\t\n\r", b"   ")
# Merging a piece of a text can take the square of its length in one of the libraries.
LONGEST_PIECE = 256


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary of a byte-level tokenizer."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def merge_encoding(content: str) -> tiktoken.Encoding | None:
    """The same tokenizer by a faster library, if its file says that it is one: plain byte-level BPE in order of its ids."""
    spec = json.loads(content)
    model, split = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
    plain = plain and split.get("use_regex", True) and not spec.get("normalizer")
    plain = plain and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    if not plain:
        return None
    chars, vocab = _byte_of_char(), model["vocab"]
    added = {token["content"] for token in spec.get("added_tokens", ())}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    tokens = {t: i for t, i in vocab.items() if t not in added}
    if merged != sorted(merged) or any(c not in chars for t in tokens for c in t) or len(tokens) != 256 + len(set(merged)):
        return None
    ranks = {bytes(map(chars.__getitem__, t)): i for t, i in tokens.items()}
    return tiktoken.Encoding("same", pat_str=SPLITS, mergeable_ranks=ranks, special_tokens={})


class ChunkEncoder:
    """Ids of texts, the same as from the tokenizer itself, for byte-level BPE tokenizers.

    Most texts are encoded by a faster library with the same merges. Those with characters that the libraries may class in
    different ways, with special tokens, or with very long pieces are cut: such a tokenizer splits a text before it
    merges bytes, and always in front of a space or around a
    line end that has no other white space beside it. So texts are cut there, and the pieces' ids are
    remembered, up to ``most`` of them. Texts with runs of white space are cut by a slower pattern.
    """

    def __init__(self, content: str, most: int = 600_000, group: int = 4_000_000, merge: bool = True):
        self.content, self.most, self.group = content, most, group
        self.known: dict[str, bytes] = {}
        self.merging = merge_encoding(content) if merge else None
        self.special = [token["content"] for token in json.loads(content).get("added_tokens", ())]

    @functools.cached_property
    def tokenizer(self) -> Tokenizer:
        """Loaded when it is needed; most tasks only have texts that the faster library encodes."""
        tokenizer = Tokenizer.from_str(self.content)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    @functools.cached_property
    def line_ids(self) -> list[int]:
        return self.tokenizer.encode("\n", add_special_tokens=False).ids

    def _merges(self, text: str) -> bool:
        """Whether the faster library gives the tokenizer's ids."""
        if self.merging is None or any(token in text for token in self.special):
            return False
        data = text.encode("utf-8", "surrogatepass")
        if data.translate(None, _KNOWN) or (not text.isascii() and _UNKNOWN_SIGN.search(data)):
            return False
        pieces = data.translate(_WHITE)
        return b" " * LONGEST_PIECE not in pieces and max(map(len, pieces.split(b" "))) <= LONGEST_PIECE

    def _cut(self, text: str) -> list[str]:
        if not text:
            return []
        if text[0].isspace() or text[-1].isspace() or "\0" in text or _ODD.search(text):
            # In front of the last space of a run that a word follows.
            return re.split(r"(?= \S)", text)
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces. Those of one word are encoded together, one per line, and told apart by the line ends."""
        words = [p for p in pieces if _WORD.fullmatch(p)]
        out: dict[str, bytes] = {}
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            ids = np.array(self.tokenizer.encode("\n".join(part), add_special_tokens=False).ids, np.uint32)
            ends = np.append(np.flatnonzero(ids == self.line_ids[0]), len(ids)) if len(self.line_ids) == 1 else [0]
            if len(ends) == len(part):
                data, begin = ids.tobytes(), 0
                for word, end in zip(part, ends.tolist()):
                    out[word] = data[4 * begin : 4 * end]
                    begin = end + 1
        rest = [p for p in pieces if p not in out]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        out |= {p: array("I", e.ids).tobytes() for p, e in zip(rest, found)}  # four bytes each, as the machine orders them
        return [out[p] for p in pieces]

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pieces that aren't known."""
        known = self.known
        ends = {p: (p[:-1], p[-1]) for p in pieces if len(p) > 2 and p[-1] in _ENDS and p[-2].isalpha()}
        parts = pieces.difference(ends)
        parts |= {part for pair in ends.values() for part in pair if part not in known}
        parts = list(parts)
        got = dict(zip(parts, self._ids(parts)))
        for piece, (word, end) in ends.items():
            got[piece] = (known.get(word) or got[word]) + (known.get(end) or got[end])
        if len(known) < self.most:
            known.update(got)
        return got

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        # A text that waits has its pieces, another one its ids.
        waiting: list[tuple[list[str], list] | np.ndarray] = []
        size = 0
        for text in texts:
            if self._merges(text):
                ids = np.frombuffer(array("I", self.merging.encode_ordinary(text)), np.uint32)
                if not waiting:
                    yield ids
                    continue
                waiting.append(ids)
            else:
                pieces = self._cut(text)
                waiting.append((pieces, list(map(self.known.get, pieces))))
            size += len(text)
            if size >= self.group:
                yield from self._filled(waiting)
                waiting, size = [], 0
        yield from self._filled(waiting)

    def _filled(self, waiting: list[tuple[list[str], list] | np.ndarray]) -> Iterator[np.ndarray]:
        cut = [w for w in waiting if isinstance(w, tuple)]
        gaps = [[k for k, ids in enumerate(found) if ids is None] if None in found else () for _, found in cut]
        new = self._learn({pieces[k] for (pieces, _), at in zip(cut, gaps) for k in at})
        for (pieces, found), at in zip(cut, gaps):
            for k in at:
                found[k] = new[pieces[k]]
        for w in waiting:
            yield np.frombuffer(b"".join(w[1]), np.uint32) if isinstance(w, tuple) else w


def worker_encoder(content: str) -> ChunkEncoder:
    """The encoder of this Python worker. Spark reuses workers, and what one has learnt outlives a task.

    It is kept in a module made for it, as functions that travel by value bring their own modules' globals.
    """
    state = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders"))
    if getattr(state, "content", None) != content:
        state.content, state.encoder = content, ChunkEncoder(content)
    return state.encoder
