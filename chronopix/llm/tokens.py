"""Token counts without token ids.

Byte-level BPE never merges across pre-tokens, so the number of pieces of a text is a sum over its pre-tokens.
The corpus's distinct pre-tokens are gathered, each is given to the tokenizer once, and the piece counts are joined to
the per-document pre-token frequencies and summed there. The counts of frequent pre-tokens, a bounded number, are sent to
where the texts are, so that their frequencies are summed in place; only the others' frequencies are shuffled to their counts,
as rows of document, pre-token (a digest, if it is long) and frequency. No list of ids is ever made.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronopix.llm.common import frequent, only, written

#: Most frequent pre-tokens whose piece counts are sent to the executors; the rest are joined.
HEAD = 200_000
#: Pre-tokens longer than this many characters go by their digest when they are joined.
KEY_CHARS = 64
#: Distinct pre-tokens, and their characters, that a task gathers before it hands them on; memory only.
KEPT, KEPT_CHARS = 100_000, 8_000_000
#: Documents whose frequencies are in memory at once.
ROWS = 512


def _class(kind: str, top: int) -> str:
    """The characters below top whose general category begins with kind, as ranges of a pattern's class."""
    runs, first = [], None
    for c in range(top + 1):
        inside = c < top and unicodedata.category(chr(c)).startswith(kind)
        if inside and first is None:
            first = c
        elif not inside and first is not None:
            runs.append(f"\\U{first:08x}-\\U{c - 1:08x}")
            first = None
    return "".join(runs)


#: Below this code point every version of Unicode since 5.2 knows the same letters and numbers.
SETTLED = 0x0530


def special_strings(tokenizer_json: str) -> list[str]:
    """The file's special strings, longest first; an error unless the file is of the kind whose counts add up over pre-tokens."""
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = json.load(f)
    pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
        raise ValueError("token counts by pre-token need a byte-level BPE file without normalizer, prefix space, truncation and padding")
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
        raise ValueError("added tokens that look at their neighbours are not supported")
    return sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)


@cache
def splitter():
    """A function from a text without special strings to its pre-tokens.

    Texts of settled characters are split by the published pattern; which rarer characters are letters depends on the
    library's version of Unicode, so other texts are split by the library itself.
    """
    from tokenizers.pre_tokenizers import ByteLevel

    # The published pattern of byte-level BPE; a letter run cannot begin with an apostrophe, so it may be tried first.
    letters, numbers, space = _class("L", SETTLED), _class("N", SETTLED), r"\t-\r\x20\x85\xa0"
    words = re.compile(f" ?[{letters}]+|'(?:[stmd]|re|ve|ll)| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+")
    rare = re.compile(f"[^\\x00-{chr(SETTLED - 1)}]")
    library = ByteLevel(add_prefix_space=False)

    def split(text: str) -> list[str]:
        if rare.search(text) is None:
            return words.findall(text)
        return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]

    return split


@cache
def _tokenizer(tokenizer_json: str):
    """The library's tokenizer, once per process, without threads of its own: a task has one core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_json)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True  # special strings were cut out before, so what comes here is ordinary text
    return tokenizer


def _cutter(special: list[str]):
    """A function from a text to what lies between its special strings."""
    return re.compile("|".join(map(re.escape, special))).split if special else lambda text: [text]


def _key(pre_token: str) -> str:
    """What a pre-token is joined by. No short one is a newline and a digest: white space and letters are never in one pre-token."""
    return pre_token if len(pre_token) <= KEY_CHARS else "\n" + hashlib.sha256(pre_token.encode()).hexdigest()


def _types(documents: DataFrame, special: list[str]) -> DataFrame:
    """piece (a distinct pre-token of all texts), n (its occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cut = splitter(), _cutter(special)
        met: Counter[str] = Counter()
        chars = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(met), pa.string()), pa.array(list(met.values()), pa.int64())], names=["piece", "n"])

        for b in batches:
            for text in b.column(0):
                text = text.as_py() or ""
                for part in cut(text):
                    met.update(split(part))
                chars += len(text)
                if len(met) > KEPT or chars > KEPT_CHARS and (chars := sum(map(len, met))) > KEPT_CHARS:
                    yield out()
                    met.clear()
                    chars = 0
        yield out()

    return documents.select("text").mapInArrow(run, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def _counted(types: DataFrame, tokenizer_json: str) -> DataFrame:
    """key, n, pieces: every distinct pre-token is tokenized here, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_json)
        for b in (b.slice(a, 5_000) for b in batches for a in range(0, b.num_rows, 5_000)):
            asked = b.column(0).to_pylist()
            counts = [len(e) for e in tokenizer.encode_batch_fast(asked, add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([pa.array(map(_key, asked), pa.string()), b.column(1), pa.array(counts, pa.int64())], names=["key", "n", "pieces"])

    return types.mapInArrow(run, "key string, n bigint, pieces bigint")


def count_tokens(documents: DataFrame, tokenizer_json: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    Counts are those of the tokenizers library for the file, without begin, end or added special tokens; special
    strings inside a text count one each, as by its default. Null and empty texts have 0 bytes and 0 tokens. Repeated
    rows give repeated results; an empty table gives an empty one; columns other than doc_id and text are not read.
    Rows are numbered by partition and place for the sum, so documents should be a table or another plan that repeats itself.
    """
    d = only(documents, doc_id="bigint", text="string")
    special = special_strings(tokenizer_json)
    counted = written(_counted(_types(d, special), tokenizer_json), "pieces")
    top = frequent(counted, "n", HEAD).select("key", "pieces").toArrow()
    head = dict(zip(top["key"].to_pylist(), top["pieces"].to_pylist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cut = splitter(), _cutter(special)
        row = (TaskContext.get().partitionId() << 40) - 1
        for block in (b.slice(a, ROWS) for b in batches for a in range(0, b.num_rows, ROWS)):
            rows, ids, sizes, sums, keys, times = [], [], [], [], [], []
            for doc_id, text in zip(block.column(0).to_pylist(), block.column(1), strict=True):
                row += 1
                text = text.as_py() or ""
                parts = cut(text)
                frequencies = Counter(split(parts[0]))
                for p in parts[1:]:
                    frequencies.update(split(p))
                own, tail = len(parts) - 1, []
                for w, k in frequencies.items():
                    pieces = head.get(w if len(w) <= KEY_CHARS else _key(w))
                    if pieces is None:
                        tail.append(w)
                    else:
                        own += k * pieces
                none = [None] * len(tail)
                rows += [row] * (1 + len(tail))
                ids += [doc_id, *none]
                sizes += [len(text.encode()), *none]
                sums += [own, *none]
                keys += [f"\n{row}", *map(_key, tail)]  # no pre-token: spreads the rows of documents over the join's partitions
                times += [0, *[frequencies[w] for w in tail]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in (rows, ids, sizes, sums)), pa.array(keys, pa.string()), pa.array(times, pa.int64())], names=["row", "doc_id", "n_bytes", "own", "key", "k"]
            )

    frequencies = d.mapInArrow(run, "row bigint, doc_id bigint, n_bytes bigint, own bigint, key string, k bigint")
    n_tokens = F.sum(F.coalesce("own", F.lit(0)) + F.col("k") * F.coalesce("pieces", F.lit(0)))
    summed = frequencies.join(counted.select("key", "pieces"), "key", "left").groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), n_tokens.alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
