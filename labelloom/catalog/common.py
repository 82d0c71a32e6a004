"""What the registered queries share: parameters, the registration helper and SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelloom.operators.sampling import SampleSpec

# Parameters that all given tables can fill: the smallest has 73 documents outside its main language.
SPEC = SampleSpec(positives=60, negatives=60, more_than=60)
IMPORTANT = 100
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "for", "les", "des", "und", "die")
JOINED = " | "


class Area:
    """Queries of one area and their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(run):
            self.queries[run.__name__] = run
            if sql is not None:
                self.sql[run.__name__] = sql
            return run

        return register


def hash60_sql(*parts: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', {', '.join(parts)})), 1, 15))::BIGINT"


def tokens_sql(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


STOP_LIST = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"

# Common table expressions in order of dependence; an unused one costs nothing.
CTES = {
    "docs": """SELECT d.doc_id AS id, split_part(d.text, chr(10), 1) AS title, d.text AS body,
        concat_ws(' ', d.lang, d.source, CASE WHEN l.quality = 1 THEN 'good' END,
                  CASE WHEN l.toxic = 1 THEN 'toxic' END) AS tags
        FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "uses": "SELECT id, unnest(string_split(tags, ' ')) AS tag FROM docs",
    "hist": "SELECT tag, count(*) AS count FROM uses GROUP BY tag",
    "frequent": f"SELECT tag, count FROM hist WHERE count > {SPEC.more_than}",
    "positive": f"""SELECT tag, id FROM (
        SELECT u.tag, u.id, row_number() OVER (
            PARTITION BY u.tag ORDER BY md5(concat_ws(':', u.tag, u.id, {SPEC.seed})), u.id) AS r
        FROM uses u JOIN frequent f ON u.tag = f.tag) WHERE r <= {SPEC.positives}""",
    "negative": f"""SELECT tag, id FROM (
        SELECT f.tag, d.id, row_number() OVER (PARTITION BY f.tag ORDER BY
            CASE WHEN {hash60_sql('d.id', str(SPEC.seed))} >= {hash60_sql('f.tag', str(SPEC.seed))}
                 THEN 0 ELSE 1 END, {hash60_sql('d.id', str(SPEC.seed))}, d.id) AS r
        FROM frequent f, docs d
        WHERE NOT list_contains(string_split(d.tags, ' '), f.tag)) WHERE r <= {SPEC.negatives}""",
    "sample": "SELECT tag, id, true AS label FROM positive UNION ALL SELECT tag, id, false FROM negative",
    "folded": f"""SELECT tag, id, label, (row_number() OVER (
            PARTITION BY tag, label ORDER BY md5(concat_ws(':', tag, id, {SPEC.seed}, 'fold')), id) - 1)
            % {SPEC.folds} AS fold FROM sample""",
    "texts": "SELECT id, concat_ws(' ', title, body) AS text FROM docs",
    "tokens": f"""SELECT id, list_filter({tokens_sql('text')}, lambda w: w NOT IN {STOP_LIST}) AS words FROM texts""",
    "counts": "SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(words) AS term FROM tokens) GROUP BY id, term",
    "sample_terms": "SELECT f.*, c.term, c.tf FROM folded f JOIN counts c USING (id)",
}


def with_sql(final: str, **more: str) -> str:
    """``final`` under the shared expressions and ``more``."""
    parts = {**CTES, **more}
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items()) + "\n" + final
