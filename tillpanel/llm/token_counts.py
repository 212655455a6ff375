"""Token counts of every document without making token ids.

A byte-level BPE never merges across pre-tokens, so a text's token count is the
sum over its distinct pre-tokens of (occurrences x pieces). Two passes:

1. every text is cut into pre-tokens by the tokenizer's own pre-tokenizer; the
   corpus-wide distinct pre-tokens are BPE-counted once each;
2. per-document pre-token frequencies are joined to those counts and summed.

Of the distinct pre-tokens the ``hot`` most frequent (a fixed number, not a
share of the data) go to the tasks as a lookup table, so a word that every
document holds is never shuffled; all others are joined by a shuffle, where no
single key is frequent any more.

Defined results: null text counts as empty (0 bytes, 0 tokens); a null
``doc_id`` stays null; repeated rows are counted row by row; strings of the
tokenizer's added tokens inside a text are one token each, as the library does
by default. Only ``doc_id`` and ``text`` are read, other columns do not matter.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpanel.llm.common import kth_largest, slices, written

HOT_PRETOKENS = 200_000
FLUSH = 300_000
#: rows of the byte-level pre-tokenizer's rule for characters up to U+024F, whose classes are the same
#: in every Unicode version; texts with others are cut by the library
_LETTER, _NUMBER, _SPACE = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", r" \t\n\r\f\v\x85\xa0"
NARROW = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_SPACE}{_LETTER}{_NUMBER}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
WIDE = re.compile("[^\0-ɏ]")


class Pretokens:
    """A tokenizer file's way of cutting texts into pre-tokens (as they stand in the text)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        # cutting needs no vocabulary, which is slow to load
        rules = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None, "decoder": None}
        self.tok = Tokenizer.from_str(json.dumps(rules))
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") is not None or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            raise ValueError("only byte-level tokenizers that take texts as they are")
        added = spec.get("added_tokens") or []
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError("added tokens that strip or need word borders are not supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None

    def cut(self, text: str) -> list[str]:
        if not WIDE.search(text):
            return NARROW.findall(text)
        return [text[a:b] for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def counts(self, text: str) -> tuple[int, list[str]]:
        """Number of added tokens in ``text``, and its pre-tokens."""
        if self.added is None or not self.added.search(text):
            return 0, self.cut(text)
        return len(self.added.findall(text)), [p for part in self.added.split(text) if part for p in self.cut(part)]


def _corpus_pretokens(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = Pretokens(path)
        c: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["pretoken", "n"])
            c.clear()
            return b

        for b in slices(batches, "text"):
            for text in b.column("text").to_pylist():
                if text:
                    c.update(pre.counts(text)[1])
            if len(c) > FLUSH:
                yield out()
        if c:
            yield out()
    return run


def _count_pieces(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer, pre_tokenizers

        model = Tokenizer.from_file(path).model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        for b in batches:
            n = [len(model.tokenize(as_bytes.pre_tokenize_str(p)[0][0])) for p in b.column("pretoken").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("pretoken"), b.column("n"), pa.array(n, pa.int32())], ["pretoken", "n", "pieces"])
    return run


def _document_pretokens(path: str, hot) -> Callable:
    """Per document: tokens of its hot pre-tokens, and the others with their frequencies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, known = Pretokens(path), hot.value
        for b in slices(batches, "text"):
            size, base, rare, often = [], [], [], []
            for text in b.column("text").to_pylist():
                text = text or ""
                n, pieces = pre.counts(text)
                others, times = [], []
                for p, f in Counter(pieces).items():
                    tokens = known.get(p)
                    if tokens is None:
                        others.append(p)
                        times.append(f)
                    else:
                        n += tokens * f
                size.append(len(text.encode()))
                base.append(n)
                rare.append(others)
                often.append(times)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), pa.array(size, pa.int64()), pa.array(base, pa.int64()),
                 pa.array(rare, pa.list_(pa.string())), pa.array(often, pa.list_(pa.int64()))],
                ["row", "doc_id", "n_bytes", "base", "rare", "often"])
    return run


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, hot: int = HOT_PRETOKENS) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` (more than ``limit`` tokens) per row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select("doc_id", "text")
    id_type = texts.schema["doc_id"].dataType.simpleString()
    vocabulary = written(
        texts.select("text").mapInArrow(_corpus_pretokens(tokenizer_path), "pretoken string, n long")
        .groupBy("pretoken").agg(F.sum("n").alias("n"))
        .mapInArrow(_count_pieces(tokenizer_path), "pretoken string, n long, pieces int"), "pretokens")
    top = vocabulary.filter(F.col("n") > kth_largest(vocabulary, "n", hot + 1)).select("pretoken", "pieces").collect()
    known = spark.sparkContext.broadcast({r[0]: r[1] for r in top})
    per_doc = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        _document_pretokens(tokenizer_path, known),
        f"row long, doc_id {id_type}, n_bytes long, base long, rare array<string>, often array<long>")
    pairs = per_doc.select("row", "doc_id", "n_bytes", "base", F.explode_outer(F.arrays_zip("rare", "often")).alias("p"))
    # a document without rare pre-tokens joins nothing; a key of its own keeps such rows apart
    pairs = pairs.select("row", "doc_id", "n_bytes", "base", F.col("p.often").alias("often"),
                         F.coalesce("p.rare", F.concat(F.lit(" \t"), F.col("row").cast("string"))).alias("pretoken"))
    joined = pairs.join(vocabulary.select("pretoken", "pieces"), "pretoken", "left")
    total = F.col("base") + F.coalesce(F.sum(F.col("often") * F.col("pieces")), F.lit(0))
    return (joined.groupBy("row", "doc_id", "n_bytes", "base").agg(total.alias("n_tokens"))
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
