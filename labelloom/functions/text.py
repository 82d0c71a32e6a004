"""Text column functions; everything stays in built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as an HTML tag, which tags open code, the blanks that are collapsed, what a token is.
HTML_TAG = "<[^<]*>"
CODE_OPENERS = ("<code>", "<pre>")
BLANKS = "[ \\t\\n\\r\\x0B\\f]+"
TOKEN = "[\\p{L}\\p{N}_]{2,}"


def squeeze_blanks(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def tag_array(tags: Column) -> Column:
    """Whitespace-separated tags as an array without empty entries."""
    return F.filter(F.split(F.coalesce(tags, F.lit("")), BLANKS), lambda t: t != "")


def model_text(title: Column, body: Column, code: Column | None = None, sep: str = " ") -> Column:
    """Text given to the models. ``sep=""`` glues title and body as the original data preparation does."""
    parts = [F.coalesce(title, F.lit("")), F.coalesce(body, F.lit(""))]
    if code is not None:
        parts.append(F.array_join(code, " "))
    return F.concat_ws(sep, *parts)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def without_words(words: Column, stop_words: Sequence[str]) -> Column:
    stop_words = list(stop_words)
    return F.filter(words, lambda w: ~w.isin(stop_words)) if stop_words else words


def with_bigrams(words: Column) -> Column:
    """The words followed by every pair of neighbours."""
    pairs = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(
        words,
        F.zip_with(
            F.slice(words, F.lit(1), pairs), F.slice(words, F.lit(2), pairs), lambda a, b: F.concat_ws(" ", a, b)
        ),
    )


def split_html(df: DataFrame, html: str = "body", prose: str = "body", code: str = "code") -> DataFrame:
    """Replace an HTML column by its prose and the array of its code blocks.

    Text belongs to the tag that follows it; text after the last tag is dropped and empty texts are skipped. A text
    followed by an opener makes the next text code. Texts are written as one letter each (``m`` = an opener follows),
    and scanning that string for ``m.`` from left to right marks the code texts, so the work is linear in the input.
    """
    source = F.coalesce(F.col(html), F.lit(""))
    others = [c for c in df.columns if c not in (html, prose, code)]
    pieces = F.filter(
        F.zip_with(
            F.split(source, HTML_TAG, -1),
            F.regexp_extract_all(source, F.lit(HTML_TAG), F.lit(0)),
            lambda text, tag: F.struct(text.alias("text"), tag.alias("tag")),
        ),
        lambda p: p["tag"].isNotNull() & (p["text"] != ""),
    )
    letters = F.array_join(
        F.transform(F.col("_pieces"), lambda p: F.when(p["tag"].isin(*CODE_OPENERS), "m").otherwise("n")), ""
    )
    marks = F.split(F.regexp_replace(letters, "m.", "mc"), "")
    marked = F.zip_with(
        F.col("_pieces"), marks, lambda p, m: F.struct(p["text"].alias("text"), (m == "c").alias("is_code"))
    )
    prose_texts = F.filter(F.col("_marked"), lambda p: p["text"].isNotNull() & ~p["is_code"])
    code_texts = F.filter(F.col("_marked"), lambda p: p["text"].isNotNull() & p["is_code"])
    return (
        df.select(*others, pieces.alias("_pieces"))
        .select(*others, marked.alias("_marked"))
        .select(
            *others,
            squeeze_blanks(F.array_join(F.transform(prose_texts, lambda p: p["text"]), "")).alias(prose),
            F.transform(code_texts, lambda p: p["text"]).alias(code),
        )
    )


def explode_once(df: DataFrame, array: str, name: str) -> DataFrame:
    """Explode a computed array so that it is computed once.

    A plain ``explode`` makes the optimizer infer a filter on the array's size and push it, with the whole
    expression behind the array, below the projections that compute it step by step.
    """
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def _run_bounds(df: DataFrame, key) -> DataFrame:
    """Add ``_starts`` and ``_ends``, the bounds of the runs of equal ``key(entry)`` in the array ``_sorted``."""
    size = F.size("_sorted")
    positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    is_start = lambda i: (i == 0) | (key(F.get("_sorted", i)) != key(F.get("_sorted", i - 1)))
    ends = F.slice(F.concat("_starts", F.array(size)), F.lit(2), F.size("_starts"))
    return df.select("*", F.filter(positions, is_start).alias("_starts")).select("*", ends.alias("_ends"))


def with_term_runs(df: DataFrame, words: str, runs: str = "runs") -> DataFrame:
    """Replace a token array by ``array<struct<term, tf>>``, counted inside the row.

    The tokens are sorted and the lengths of equal runs are the term counts, so no shuffle is needed and the rows keep
    the partitioning they came with.
    """
    others = [c for c in df.columns if c != words]
    counted = F.zip_with(
        "_starts",
        "_ends",
        lambda start, end: F.struct(F.get("_sorted", start).alias("term"), (end - start).cast("long").alias("tf")),
    )
    bounds = _run_bounds(df.select(*others, F.sort_array(words).alias("_sorted")), lambda entry: entry)
    return bounds.select(*others, counted.alias(runs))


def explode_runs(df: DataFrame, runs: str = "runs") -> DataFrame:
    others = [c for c in df.columns if c != runs]
    return explode_once(df, runs, "_run").select(*others, "_run.term", "_run.tf")


def count_terms(df: DataFrame, words: str) -> DataFrame:
    """Explode a token array into ``(other columns, term, tf)``."""
    return explode_runs(with_term_runs(df, words))


def hash60(*parts: Column) -> Column:
    """60-bit hash of the ``:``-joined parts, reproducible in any SQL engine that has md5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")
