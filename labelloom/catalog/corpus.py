"""Reading, cleaning and tokenising."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import JOINED, STOP_LIST, STOP_WORDS, Area, tokens_sql, with_sql
from labelloom.functions import text as T
from labelloom.operators import clean
from labelloom.session import new_path
from labelloom.sources import questions as Q
from labelloom.sources import sinks
from labelloom.sources.large_csv import read_large_questions_csv

area = Area()

# The cleaning rules restated over rows: runs of texts before an opener alternate between opening and being code.
CLEAN = {
    "raw": """SELECT page_id AS id, url AS title, replace(replace(replace(html, '<article>', 'x<pre>'),
        '<b>', 'y <code>'), '<li>', 'z<code>') AS body FROM pages""",
    "cut": """SELECT id, string_split_regex(body, '<[^<]*>') AS texts, regexp_extract_all(body, '<[^<]*>') AS marks
        FROM raw""",
    "pieces": """SELECT id, unnest(range(1, len(marks) + 1)) AS place, unnest(texts[1:len(marks)]) AS piece,
        unnest(marks) AS mark FROM cut""",
    "numbered": """SELECT id, piece, mark IN ('<code>', '<pre>') AS opener,
        row_number() OVER (PARTITION BY id ORDER BY place) AS k FROM pieces WHERE piece <> ''""",
    "runs": """SELECT *, k - coalesce(max(CASE WHEN NOT opener THEN k END) OVER (
        PARTITION BY id ORDER BY k ROWS UNBOUNDED PRECEDING), 0) AS run FROM numbered""",
    "roles": """SELECT *, coalesce(lag(opener AND run % 2 = 1) OVER (PARTITION BY id ORDER BY k), false) AS is_code
        FROM runs""",
    "cleaned": f"""SELECT r.id, r.title,
        trim(regexp_replace(coalesce(string_agg(piece, '' ORDER BY k) FILTER (WHERE NOT is_code), ''),
             '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')) AS body,
        coalesce(string_agg(piece, '{JOINED}' ORDER BY k) FILTER (WHERE is_code), '') AS code,
        coalesce(string_agg(piece, ' ' ORDER BY k) FILTER (WHERE is_code), '') AS code_text,
        count(*) FILTER (WHERE is_code) AS code_blocks
        FROM raw r LEFT JOIN roles s ON r.id = s.id GROUP BY r.id, r.title""",
}


def _shown(cleaned):
    return cleaned.select(
        "id",
        "title",
        "body",
        F.array_join("code", JOINED).alias("code"),
        F.size("code").cast("long").alias("code_blocks"),
    )


@area.add(with_sql("SELECT id, title, body, tags FROM docs"))
def question_csv_scan(spark, folder):
    """Questions written as CSV (quoted line breaks, doubled quotes) and scanned back."""
    path = new_path(spark, "question-csv")
    Q.questions_from_documents(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    return Q.read_questions_csv(spark, path)


@area.add(with_sql("SELECT id, title, body, tags FROM docs"))
def question_csv_ranges(spark, folder):
    """The same files scanned in byte ranges of 256 KB, records with line breaks put together across their borders."""
    path = new_path(spark, "question-csv")
    Q.questions_from_documents(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    return read_large_questions_csv(spark, path, range_bytes=256 << 10)


@area.add(with_sql("SELECT id, body, code, code_blocks FROM cleaned", **CLEAN))
def corpus_by_id(spark, folder):
    """All pages and an older version of each under the same id: the last row of each id wins and is cleaned."""
    pages = Q.questions_from_pages(spark, folder)
    older = pages.withColumn("body", F.concat(F.lit("<p>older</p>"), F.reverse("body"))).withColumn("line", F.lit(0))
    latest = Q.latest_by_id(pages.withColumn("line", F.lit(1)).unionByName(older), "line")
    return _shown(clean.clean_questions(latest)).drop("title")


@area.add(with_sql("SELECT id, body, code, code_blocks FROM cleaned", **CLEAN))
def html_prose_and_code(spark, folder):
    pages = Q.questions_from_pages(spark, folder)
    return _shown(clean.clean_questions(pages)).drop("title")


@area.add(with_sql("SELECT id, title, body, code, code_blocks FROM cleaned", **CLEAN))
def clean_corpus_table(spark, folder):
    """The clean corpus written as a table and read back; a second write changes nothing."""
    path = new_path(spark, "clean-corpus")
    cleaned = clean.clean_questions(Q.questions_from_pages(spark, folder))
    sinks.write_clean_corpus(cleaned, path)
    sinks.write_clean_corpus(cleaned, path)
    return _shown(spark.read.parquet(path))


@area.add(
    with_sql(
        """SELECT id, trim(regexp_replace(body, '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g')) AS body FROM docs"""
    )
)
def squeezed_blanks(spark, folder):
    questions = Q.texts_from_documents(spark, folder)
    return questions.select("id", T.squeeze_blanks(F.col("body")).alias("body"))


@area.add(with_sql("SELECT id, title || body AS glued, title || ' ' || body AS spaced FROM docs"))
def model_input_text(spark, folder):
    title, body = F.col("title"), F.col("body")
    return Q.texts_from_documents(spark, folder).select(
        "id", T.model_text(title, body, sep="").alias("glued"), T.model_text(title, body).alias("spaced")
    )


@area.add(
    with_sql(
        """SELECT id, title || ' ' || body AS text, title || ' ' || body || ' ' || code_text AS text_with_code
            FROM cleaned""",
        **CLEAN,
    )
)
def clean_document_text(spark, folder):
    cleaned = clean.clean_questions(Q.questions_from_pages(spark, folder))
    return cleaned.select(
        "id",
        T.model_text(F.col("title"), F.col("body")).alias("text"),
        T.model_text(F.col("title"), F.col("body"), F.col("code")).alias("text_with_code"),
    )


@area.add(
    with_sql(
        f"""SELECT id, array_to_string({tokens_sql('text')}, ' ') AS words,
            len({tokens_sql('text')})::BIGINT AS n FROM texts"""
    )
)
def tokens(spark, folder):
    words = clean.document_terms(clean.model_input(Q.texts_from_documents(spark, folder)))
    return words.select("id", F.array_join("terms", " ").alias("words"), F.size("terms").cast("long").alias("n"))


@area.add(
    f"""SELECT conv_id, turn, array_to_string(list_filter({tokens_sql('text')}, lambda w: w NOT IN {STOP_LIST}), ' ')
        AS words FROM conversations"""
)
def tokens_without_stop_words(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "text")
    words = clean.document_terms(rows, STOP_WORDS)
    return words.select("conv_id", "turn", F.array_join("terms", " ").alias("words"))


@area.add(
    with_sql(
        """SELECT id, list_reduce(list_prepend('', list_concat(words, pairs)), lambda x, y: x || ',' || y) AS terms
            FROM (SELECT id, words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
                  AS pairs FROM tokens)"""
    )
)
def words_and_pairs(spark, folder):
    texts = clean.model_input(Q.texts_from_documents(spark, folder))
    terms = clean.document_terms(texts, STOP_WORDS, bigrams=True)
    return terms.select("id", F.array_join(F.array_prepend("terms", F.lit("")), ",").alias("terms"))


# Every word of the benchmark is a stop word here, so that the list is as long as the data makes it.
@area.add(
    with_sql(
        f"""SELECT id, count(*) AS kept FROM (SELECT id, unnest({tokens_sql('text')}) AS word FROM texts) t
            WHERE word NOT IN (SELECT unnest({tokens_sql('text')}) FROM benchmark) GROUP BY id"""
    )
)
def stop_word_file(spark, folder):
    """A word list with blanks around its words, loaded as a table and taken out of the words of all documents."""
    path = new_path(spark, "stop-words")
    listed = clean.document_terms(spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").alias("id"), "text"))
    words = listed.select(F.explode("terms").alias("word")).distinct()
    words.select(F.concat(F.lit("  "), "word", F.lit(" ")).alias("value")).write.text(path)
    texts = clean.model_input(Q.texts_from_documents(spark, folder))
    terms = clean.without_stop_words(clean.document_terms(texts), Q.load_stop_words(spark, path))
    return terms.groupBy("id").agg(F.count("*").alias("kept"))

