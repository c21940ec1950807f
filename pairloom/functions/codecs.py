"""Text codecs: what turns a text into token ids and back.

A codec is a small picklable object. A built-in codec gives a column expression
(``encode_column``); an external one gives ``encode_batch`` over a list of texts and
runs on Arrow batches inside the tasks, loading its model once per Python worker.
"""

from collections.abc import Callable, Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from pairloom.functions import text as tx


class Codec:
    """Base class. ``fields`` are the integer lists that an encoding consists of."""

    name = "codec"
    fields: tuple[str, ...] = ("input_ids", "attention_mask")
    eos_token_id: int | None = None
    pad_token_id: int | None = None
    bos_token_id: int | None = None
    unk_token_id: int | None = None
    vocab_size: int | None = None

    def encode_batch(self, texts: Sequence[str], **options) -> list[Mapping[str, Sequence[int]]]:
        raise NotImplementedError

    def decode_batch(self, ids: Sequence[Sequence[int]]) -> list[str]:
        """Texts of the id lists, without special tokens."""
        raise NotImplementedError


class WordLengthCodec(Codec):
    """Splits on whitespace; the id of a token is its length. Needs no model.

    A built-in expression, so texts never leave the JVM. ``truncation`` with
    ``max_length`` keeps the first tokens.
    """

    name = "word-length"
    eos_token_id = 0
    pad_token_id = 0

    def __init__(self, vocab_size: int = 1024):
        self.vocab_size = vocab_size

    def encode_column(self, text: Column, **options) -> Column:
        stripped = tx.strip(text)
        # Only a blank text would split into an empty word.
        words = F.when(stripped == "", F.array().cast("array<string>")).otherwise(F.split(stripped, f"[{tx.WS}]++"))
        if options.get("truncation") and options.get("max_length") is not None:
            words = F.slice(words, 1, int(options["max_length"]))
        ids = F.transform(words, F.length)
        return F.transform(
            F.array(ids),
            lambda i: F.struct(
                i.alias("input_ids"), F.array_repeat(F.lit(1), F.size(i)).alias("attention_mask")
            ),
        )[0]


class ExternalCodec(Codec):
    """Wraps a tokenizer of the common form ``tokenizer(text, **options) -> mapping``.

    ``load`` builds the tokenizer. It is called on the driver for the special ids and
    the vocabulary size, and once per Python worker for the texts, so the tokenizer
    itself is never pickled. With ``lists``, the tokenizer takes a list of texts and returns
    lists of ids, and is called once per batch instead of once per text.
    """

    def __init__(
        self,
        load: Callable[[], Any],
        name: str,
        fields: tuple[str, ...] = ("input_ids", "attention_mask"),
        lists: bool = False,
    ):
        self.load, self.name, self.fields, self.lists = load, name, fields, lists
        self._tokenizer = None

    def __getstate__(self):
        return {**self.__dict__, "_tokenizer": None}

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            self._tokenizer = self.load()
        return self._tokenizer

    def __getattribute__(self, attribute):
        if attribute in ("eos_token_id", "pad_token_id", "bos_token_id", "unk_token_id", "vocab_size"):
            return getattr(self.tokenizer, attribute, None)
        return super().__getattribute__(attribute)

    def encode_batch(self, texts, **options):
        if not self.lists:
            return [self.tokenizer(text, **options) for text in texts]
        found = self.tokenizer(list(texts), **options)
        return [dict(zip(self.fields, row)) for row in zip(*(found[name] for name in self.fields))]

    def decode_batch(self, ids):
        return [self.tokenizer.decode(list(row), skip_special_tokens=True) for row in ids]


class FileCodec(Codec):
    """A tokenizer stored as one JSON file, read with the ``tokenizers`` package.

    The driver reads the file and its content travels with the codec, so executors need no copy.
    Padding that the file asks for is left out, and truncation is the tokenizer's own: it keeps the special tokens.
    """

    def __init__(self, path: str, name: str | None = None, **special_ids: int):
        self.path, self.name = path, name or path
        self.content = Path(path).read_text(encoding="utf-8")
        for key, value in special_ids.items():
            setattr(self, f"{key}_token_id", value)
        self._tokenizer = None
        self.vocab_size = self.tokenizer.get_vocab_size()

    def __getstate__(self):
        return {**self.__dict__, "_tokenizer": None}

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_str(self.content)
            self._tokenizer.no_padding()
        return self._tokenizer

    def encode_batch(self, texts, *, truncation=False, max_length=None, add_special_tokens=True):
        if truncation and max_length is not None:
            self.tokenizer.enable_truncation(max_length)
        else:
            self.tokenizer.no_truncation()
        encoded = self.tokenizer.encode_batch(list(texts), add_special_tokens=add_special_tokens)
        return [{"input_ids": e.ids, "attention_mask": e.attention_mask} for e in encoded]

    def decode_batch(self, ids):
        return self.tokenizer.decode_batch([list(row) for row in ids], skip_special_tokens=True)


def training_token_ids(codec: Codec) -> dict[str, int]:
    """Padding, begin and end ids for training.

    End and padding must exist. A missing begin id becomes the one after the largest
    of end, padding and unknown.
    """
    for needed in ("eos_token_id", "pad_token_id"):
        if getattr(codec, needed) is None:
            raise ValueError(f"codec {codec.name!r} must define {needed}")
    bos = codec.bos_token_id
    if bos is None:
        known = (codec.eos_token_id, codec.pad_token_id, codec.unk_token_id)
        bos = 1 + max(i for i in known if i is not None)
    return {
        "src_pad_id": int(codec.pad_token_id),
        "tgt_pad_id": int(codec.pad_token_id),
        "tgt_bos_id": int(bos),
        "tgt_eos_id": int(codec.eos_token_id),
    }
