"""Token counts: batch encoding in Arrow functions that return lengths only.

Each Arrow batch is cut into encode batches of nearly equal bytes; only the
lengths leave the worker, never ids.  A text longer than ``LONG`` characters is
first split at safe boundaries, places that no token can span, so one very
long text is encoded in several batches of bounded size and its pieces' lengths
are added.  Counts are those of the library over the whole text:

* ``.json`` (tokenizers): special strings inside texts as the library's default
  has them; no begin, end or added tokens, no truncation, no padding.
* ``.model`` (sentencepiece): no begin or end.

Safe boundaries.  The byte-level split pattern never joins a character other
than white space with white space after it, a letter with a digit, or closing
punctuation with a letter; so a text may be cut there, if no added token holds
white space or takes some from its neighbours.  In a sentencepiece model a blank
starts a piece; where no piece of the vocabulary holds a word mark after another
character, a text may be cut at a single blank, which the model's own leading
mark stands for.  A vocabulary without these properties, and a stretch without
such a place, is encoded whole.

Defined cases: a NULL or empty text has 0 bytes and 0 tokens.  Rows are counted
one by one: NULL or repeated doc_ids stay as they are.  An empty table gives no
row.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverflow.llm import kernel as K
from riverflow.llm.common import ready, table

LIMIT = 1024            # over_limit: more tokens than this
LONG = 1 << 16          # characters; longer texts are split
BATCH_BYTES = 1 << 18   # of an encode batch

# A blank, tab or line end after a character that is surely not white space.
_BLANK = r"(?<=[!-~\p{L}\p{N}])(?=[ \t\r\n])"
# Also between letters and digits, and after closing punctuation (never an
# apostrophe, which starts a contraction).
_INSIDE = (r"|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"
           r"|(?<=[.,!?;:)\]。、，！？；：])(?=[A-Za-z0-9一-龥ぁ-ゖァ-ヺ])")
_SPACED = regex.compile(_BLANK)
_ANY = regex.compile(_BLANK + _INSIDE)
_SINGLE = regex.compile(r"(?<=[!-~\p{L}\p{N}]) (?=[!-~\p{L}\p{N}])")


def split_at(text: str, pattern, long: int = LONG, drop: int = 0) -> list[str]:
    """``text`` cut at the first match of ``pattern`` after every ``long``
    characters; ``drop`` characters at each cut are left out."""
    out, at = [], 0
    while len(text) - at > long:
        found = pattern.search(text, at + long)
        if found is None:
            break
        out.append(text[at:found.start()])
        at = found.start() + drop
    out.append(text[at:])
    return out


def balanced(sizes: np.ndarray, target: int) -> list[tuple[int, int]]:
    """(first, last) of consecutive batches of nearly equal bytes, each about
    ``target`` at most unless one text alone is larger."""
    if not len(sizes):
        return []
    ends = np.cumsum(sizes)
    k = max(1, -(-int(ends[-1]) // target))
    cuts = np.searchsorted(ends, ends[-1] * np.arange(1, k) / k, side="right")
    edges = np.unique(np.concatenate([[0], cuts, [len(sizes)]]))
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


class JsonCounter:
    """Token counts of a tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens", [])
        self.added = [t["content"] for t in added]
        self.splits = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                       and not pre.get("add_prefix_space") and not spec.get("normalizer")
                       and not any(t["rstrip"] or t["single_word"] or regex.search(r"\s", t["content"]) for t in added))

    def pieces(self, text: str, long: int) -> list[str]:
        if len(text) <= long or not self.splits:
            return [text]
        return split_at(text, _SPACED if any(t in text for t in self.added) else _ANY, long)

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class PieceCounter:
    """Token counts of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # a cut is safe if no piece spans it and the leading mark is one mark
        self.splits = (not any(regex.search("[^▁]▁", n) for n in names)
                       and "▁" in names and self._marks("a b") == self._marks("a") + self._marks("b"))

    def _marks(self, text: str) -> list[str]:
        return self.model.encode(text, out_type=str)

    def pieces(self, text: str, long: int) -> list[str]:
        return [text] if len(text) <= long or not self.splits else split_at(text, _SINGLE, long, drop=1)

    def lengths(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, out_type=int, num_threads=1)]


_COUNTERS: dict[str, JsonCounter | PieceCounter] = K.HELD.setdefault("token_counts", {})


def counter(path: str) -> JsonCounter | PieceCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = (PieceCounter if path.endswith(".model") else JsonCounter)(path)
    return _COUNTERS[path]


def count_texts(count, texts: list[str], long: int = LONG, batch_bytes: int = BATCH_BYTES) -> np.ndarray:
    """Tokens of each text."""
    pieces, owner = [], []
    for i, text in enumerate(texts):
        cut = count.pieces(text, long)
        pieces += cut
        owner += [i] * len(cut)
    out = np.zeros(len(texts), np.int64)
    sizes = np.array([len(p) for p in pieces], np.int64) + 1
    for a, b in balanced(sizes, batch_bytes):
        np.add.at(out, owner[a:b], count.lengths(pieces[a:b]))
    return out


def _count(path: str, limit: int, long: int, batch_bytes: int):
    def run(batches):
        count = counter(path)
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in balanced(sizes + 1, 8 * batch_bytes):
                some = [t or "" for t in texts.slice(a, b - a).to_pylist()]
                tokens = count_texts(count, some, long, batch_bytes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sizes[a:b]), pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return run


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text", long: int = LONG, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit
    (more than ``limit`` tokens).  ``tokenizer_path`` (.json or .model) is read
    by the tasks: the tokenizer package is installed on every executor."""
    ready(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(K.lean("token_counts", _count(tokenizer_path, limit, long, batch_bytes)),
                            f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op13_token_counts(spark, sf_dir):
    """Token counts of all documents."""
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
