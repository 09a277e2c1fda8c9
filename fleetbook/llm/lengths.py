"""Exact histogram of encoded lengths, and what follows from its sums.

Documents are encoded whole, in Arrow batches, and counted by number of tokens. Sums over
the histogram answer for every context limit L how many tokens remain if each document is
cut to L tokens: the tokens of the documents up to L, and L for each longer one. Running
sums go over runs of lengths first and then over the run totals, so no task holds all.

The vocabulary is a rank file of a public tokenizer; its path is a parameter and must be
readable on every executor.

Defined cases: null and empty texts have length 0; runs of white space may have any length; repeated rows count each; text of
special tokens is ordinary text; no rows give no rows.
"""

import base64
import re

import pyarrow as pa
from pyspark.sql import Window, functions as F

from fleetbook.llm.tables import stage, texts

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the public vocabulary splits text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RUN = 1024                       # lengths in a run of the running sums
#: Runs of white space (the Unicode property) too long for the encoder's split pattern.
LONG = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{1000,}")

_CODERS = {}


def coder(path, pattern=PATTERN):
    """The encoder of a rank file, made once per worker."""
    if (path, pattern) not in _CODERS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _CODERS[path, pattern] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _CODERS[path, pattern]


def n_tokens(encoding, text):
    """Number of tokens of a whole text. The split pattern makes one piece of a run of white
    space, without its last character where a word follows; long runs, on which the pattern
    would exhaust the stack, are cut out and encoded as that piece."""
    n, at = 0, 0
    for run in LONG.finditer(text):
        end = run.end() - (run.end() < len(text))
        n += len(encoding.encode_ordinary(text[at:run.start()])) + len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return n + len(encoding.encode_ordinary(text[at:]))


def encoded_lengths(docs, ranks=RANKS):
    """doc_id and n_tokens of every row."""
    def run(batches):
        encoding = coder(ranks)
        for batch in batches:
            lengths = [n_tokens(encoding, text.as_py() or "") for text in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long")


def histogram(lengths):
    """n_tokens, n_docs: exact counts by length."""
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def running(hist):
    """For each occurring length L: docs_upto and tokens_upto (of documents up to L),
    docs_longer and tokens_longer (suffix sums), truncated_total (tokens left if all are cut
    to L), and share_upto (the quantile L is at)."""
    hist = hist.withColumn("run", F.floor(F.col("n_tokens") / RUN)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    ahead = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # One row per run of lengths: few, whatever the number of documents.
    runs = hist.groupBy("run").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    runs = runs.select(
        "run", F.coalesce(F.sum("d").over(ahead), F.lit(0)).alias("d0"), F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("t0"),
        F.sum("d").over(everything).alias("docs"), F.sum("t").over(everything).alias("total"))
    inside = Window.partitionBy("run").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    upto = hist.select("run", "n_tokens", "n_docs", F.sum("n_docs").over(inside).alias("d"), F.sum("tokens").over(inside).alias("t"))
    return upto.join(runs, "run").select(
        "n_tokens", "n_docs", (F.col("d0") + F.col("d")).alias("docs_upto"), (F.col("t0") + F.col("t")).alias("tokens_upto"),
        (F.col("docs") - F.col("d0") - F.col("d")).alias("docs_longer"),
        (F.col("total") - F.col("t0") - F.col("t")).alias("tokens_longer"),
        (F.col("t0") + F.col("t") + F.col("n_tokens") * (F.col("docs") - F.col("d0") - F.col("d"))).alias("truncated_total"),
        ((F.col("d0") + F.col("d")) / F.col("docs")).alias("share_upto"))


def at_limits(sums, limits):
    """limit, truncated_total, docs_longer for a list of context limits."""
    cut = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in sorted(set(limits))])).alias("limit")
    kept = F.least("n_tokens", "limit") * F.col("n_docs")
    longer = F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)
    return sums.select("n_tokens", "n_docs", cut).groupBy("limit").agg(
        F.sum(kept).alias("truncated_total"), F.sum(longer).alias("docs_longer"))


def quantile(sums, share):
    """The least length that at least ``share`` of the documents do not exceed."""
    return sums.filter(F.col("share_upto") >= share).agg(F.min("n_tokens").alias("n_tokens"))


def token_histogram(docs, ranks=RANKS):
    """The histogram with its running sums, one row per occurring length."""
    return running(stage(histogram(encoded_lengths(docs, ranks)), "lengths"))
