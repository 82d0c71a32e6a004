"""Dense features and trained classifiers. SQL states what was trained on and searched, and first splits; tests the rest."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelloom.catalog.common import SPEC, STOP_WORDS, Area, with_sql
from labelloom.catalog.features import HASHED, document_texts
from labelloom.catalog.sampling import drawn
from labelloom.operators import boosting, evaluate, families, forest, lsa, passes, sampling, signs, svm
from labelloom.operators import features as X
from labelloom.session import new_path, stage

area = Area()


def _fitted(texts):
    """Sparse rows of the texts and the basis fitted on them."""
    rows = stage(X.hashed_rows(texts, STOP_WORDS), "hashed-rows")
    return rows, lsa.fit_lsa(rows)


@area.add()
def lsa_features(spark, folder):
    rows, basis = _fitted(document_texts(spark, folder))
    return lsa.project(rows, basis)


@area.add()
def pca_features(spark, folder):
    rows = stage(X.hashed_rows(document_texts(spark, folder), STOP_WORDS), "hashed-rows")
    return lsa.project(rows, lsa.fit_pca(rows))


def _checks_sql(components):
    return with_sql(
        f"""SELECT count(*) AS documents, {components}::BIGINT AS components, 1 AS orthonormal, 1 AS falling, 1 AS squares_kept
            FROM docs"""
    )


def _checked(spark, rows, fit, name):
    """Facts about a basis that was stored and loaded again."""
    path = new_path(spark, name)
    lsa.basis_table(spark, fit(rows)).write.parquet(path)
    basis = lsa.load_basis(spark.read.parquet(path))
    return lsa.basis_checks(stage(lsa.project(rows, basis), "projected"), basis)


@area.add(_checks_sql(lsa.COMPONENTS))
def lsa_basis_checks(spark, folder):
    rows = stage(X.hashed_rows(document_texts(spark, folder), STOP_WORDS), "hashed-rows")
    return _checked(spark, rows, lsa.fit_lsa, "lsa-basis")


@area.add(_checks_sql(lsa.PRINCIPAL))
def pca_basis_checks(spark, folder):
    rows = stage(X.hashed_rows(document_texts(spark, folder), STOP_WORDS), "hashed-rows")
    return _checked(spark, rows, lsa.fit_pca, "pca-basis")


def _blocks(spark, folder, *kinds):
    """Blocks of every tag's sample, of LSA features (``f8``) or their bins (``u1``), and what made the features."""
    folded = stage(sampling.stratified_folds(drawn(spark, folder)[1], SPEC), "folds")
    rows, basis = _fitted(X.sample_texts(folded, document_texts(spark, folder)))
    features = stage(lsa.project(rows, basis), "sample-features")
    edges = forest.bin_edges(features) if "u1" in kinds else None
    found = []
    for kind in kinds:
        values = stage(forest.binned(features, edges), "bins") if kind == "u1" else features
        found.append(stage(passes.row_blocks(values.join(folded, "id"), SPEC.rows, SPEC.folds, kind), "blocks"))
    return *found, basis, edges


# Below what was measured at all given sizes: languages are easy to tell (0.89 at least, 0.71 by the signs alone), other
# tags of the given tables are nearly noise.
LANGUAGES, LANGUAGE_FLOOR, SIGNS_FLOOR, FLOOR = ("de", "en", "es", "fr"), 0.8, 0.5, 0.1


def _surveyed(scores, *params, language_floor=LANGUAGE_FLOOR):
    """Rows and positives of every left-out fold, grid points scored on it, and whether the best one's mean is fair."""
    scores = stage(scores, "fold-scores")
    best = evaluate.best_params(evaluate.score_report(scores, *params), *params)
    floor = F.when(F.col("tag").isin(*LANGUAGES), language_floor).otherwise(FLOOR)
    fair = best.select("tag", (F.col("mean_f1") >= floor).cast("int").alias("at_floor"))
    folds = scores.groupBy("tag", "fold").agg(
        F.max("n").alias("n"), F.max("positives").alias("positives"), F.count("*").alias("points")
    )
    return folds.withColumn("fold", F.col("fold").cast("long")).join(fair, "tag")


def _surveyed_sql(points):
    return with_sql(
        f"""SELECT tag, fold::BIGINT AS fold, count(*) AS n, count(*) FILTER (WHERE label) AS positives,
            {points}::BIGINT AS points, 1 AS at_floor FROM folded GROUP BY tag, fold"""
    )


@area.add(_surveyed_sql(len(signs.ALPHAS)))
def survey_bernoulli_nb(spark, folder):
    """All smoothings for all tags and folds from one count of signs."""
    blocks, *_ = _blocks(spark, folder, "f8")
    found = signs.fit(blocks, blocks.select("tag").distinct(), SPEC.folds, lsa.COMPONENTS)
    return _surveyed(signs.fold_scores(blocks, found), "alpha", language_floor=SIGNS_FLOOR)


@area.add(_surveyed_sql(len(svm.C_VALUES)))
def survey_linear_svc(spark, folder):
    """The whole grid of costs for all tags and folds in one run."""
    blocks, *_ = _blocks(spark, folder, "f8")
    found = svm.fit(blocks, svm.grid(blocks.select("tag").distinct(), SPEC.folds), lsa.COMPONENTS)
    return _surveyed(svm.fold_scores(blocks, found), "c")


FOREST_POINTS = len(forest.TREES) * len(forest.IMPURITIES) * len(forest.SUBSETS) * len(forest.MIN_SPLIT)


@area.add(_surveyed_sql(FOREST_POINTS))
def survey_random_forest(spark, folder):
    """The whole grid of forests for all tags and folds, level by level."""
    blocks, *_ = _blocks(spark, folder, "u1")
    found = forest.fit(blocks, forest.grid(blocks.select("tag").distinct(), SPEC.folds, lsa.COMPONENTS))
    return _surveyed(forest.fold_scores(blocks, found), "trees", "impurity", "subset", "min_split")


ROOT_BUCKETS = 256


def _mixed_sql(x, name):
    """Expressions of the forests' hash of ``x``, one after the other."""
    p = forest.PRIME
    return {
        f"{name}0": f"SELECT *, ({x})::BIGINT % {p} AS h0 FROM",
        f"{name}1": f"SELECT *, (h0 * h0 + 48271) % {p} AS h1 FROM",
        f"{name}2": f"SELECT * EXCLUDE (h0, h1), (((h1 * h1 + h0) % {p}) * 69621) % {p} AS h FROM",
    }


def _hashed_by(source, x, name):
    sql = source
    for text in _mixed_sql(x, name).values():
        sql = f"({text} {sql})"
    return sql


def _roots_sql():
    trees, dims = max(forest.TREES), ROOT_BUCKETS
    times = " + ".join(f"(h >= {t})::INT" for t in forest.POISSON)
    row_hash = _hashed_by("(SELECT DISTINCT id FROM folded)", "id", "r")
    weight_hash = _hashed_by(
        f"(SELECT id, h AS rh, unnest(range({trees})) AS tree FROM {row_hash})", "rh * 31 + (tree + 1) * 1000003", "w"
    )
    tree_hash = _hashed_by(f"(SELECT unnest(range({trees})) AS tree)", "tree * 1000003 + 7919 + 1", "t")
    order_hash = _hashed_by(
        f"(SELECT tree, h AS th, unnest(range({dims})) AS feature FROM {tree_hash})", "th + feature * 104729", "f"
    )
    side = lambda a, b: f"({a} * {a} + {b} * {b}) / ({a} + {b})::DOUBLE"
    xlog = lambda v: f"({v}) * ln(greatest({v}, 1)::DOUBLE)"
    cross = lambda a, b: f"{xlog(a)} + {xlog(b)} - ({xlog(f'{a} + {b}')})"
    subsets = ", ".join(f"('{s}', {forest.subset_size(s, dims)})" for s in forest.SUBSETS)
    return with_sql(
        """SELECT r.tag, r.fold, r.impurity, r.subset, m.min_split::INTEGER AS min_split, r.tree::INTEGER AS tree,
            r.feature::INTEGER AS feature, r.bin::INTEGER AS bin
            FROM ranked r, (SELECT unnest([2, 3]) AS min_split) m WHERE r.place = 1""",
        signed=HASHED["signed"].replace("% 4096", f"% {dims}"),
        hashed=HASHED["hashed"],
        times=f"SELECT id, tree, {times} AS w FROM {weight_hash}",
        choice=f"""SELECT s.subset, o.tree, o.feature FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY h, feature) AS place
            FROM {order_hash}) o JOIN (VALUES {subsets}) s(subset, k) ON o.place <= s.k""",
        train="""SELECT f.tag, g.fold, f.id, f.label, t.tree, t.w FROM folded f JOIN times t USING (id)
            JOIN (SELECT DISTINCT fold FROM folded) g ON f.fold <> g.fold WHERE t.w > 0""",
        totals="""SELECT tag, fold, tree, sum(w) FILTER (WHERE label) AS p, sum(w) AS n FROM train GROUP BY ALL""",
        cells=f"""SELECT t.tag, t.fold, t.tree, c.subset, c.feature, least(coalesce(h.tf, 0), {forest.BINS - 1}) AS bin,
            coalesce(sum(w) FILTER (WHERE label), 0) AS p, sum(w) AS n
            FROM train t JOIN choice c ON t.tree = c.tree LEFT JOIN hashed h ON h.id = t.id AND h.bucket = c.feature GROUP BY ALL""",
        sides="""SELECT c.tag, c.fold, c.tree, c.subset, c.feature, c.bin, (sum(c.p) OVER line)::BIGINT AS lp,
            (sum(c.n) OVER line - sum(c.p) OVER line)::BIGINT AS ln_, t.p::BIGINT AS p, (t.n - t.p)::BIGINT AS n
            FROM cells c JOIN totals t USING (tag, fold, tree)
            WINDOW line AS (PARTITION BY c.tag, c.fold, c.tree, c.subset, c.feature ORDER BY c.bin)""",
        valid="SELECT *, p - lp AS rp, n - ln_ AS rn FROM sides WHERE p > 0 AND n > 0 AND lp + ln_ < p + n",
        gains=f"""SELECT *, unnest(['gini', 'entropy']) AS impurity,
            unnest([{side('lp', 'ln_')} + {side('rp', 'rn')}, {cross('lp', 'ln_')} + {cross('rp', 'rn')}]) AS gain FROM valid""",
        ranked="""SELECT *, row_number() OVER (PARTITION BY tag, fold, tree, subset, impurity
            ORDER BY round(gain, 6) DESC, feature, bin) AS place FROM gains""",
    )


@area.add(_roots_sql())
def forest_root_splits(spark, folder):
    """The first split of every tree of the grid, on hashed counts, which SQL can state."""
    blocks = _count_blocks(spark, folder)
    jobs = forest.grid(blocks.select("tag").distinct(), SPEC.folds, ROOT_BUCKETS)
    splits = forest.root_splits(forest.fit(blocks, jobs, max_depth=1))
    return splits.where("feature >= 0").withColumn("fold", F.col("fold").cast("long"))


BOOSTING_POINTS = len(boosting.TREES) * len(boosting.SUBSETS) * len(boosting.MIN_SPLIT)


@area.add(_surveyed_sql(BOOSTING_POINTS))
def survey_gradient_boosting(spark, folder):
    """The whole grid of boosted trees for all tags and folds, read off after 100, 200 and 300 trees."""
    blocks, *_ = _blocks(spark, folder, "u1")
    found = stage(boosting.fit(blocks, boosting.grid(blocks.select("tag").distinct(), SPEC.folds)), "boosted")
    return _surveyed(boosting.fold_scores(blocks, found), "trees", "subset", "min_split")


def _first_splits_sql():
    tree_hash = _hashed_by("(SELECT 0 AS tree)", "tree * 1000003 + 7919 + 1", "t")
    order_hash = _hashed_by(
        f"(SELECT h AS th, unnest(range({ROOT_BUCKETS})) AS feature FROM {tree_hash})", "th + feature * 104729", "f"
    )
    subsets = ", ".join(f"('{s}', {forest.subset_size(s, ROOT_BUCKETS)})" for s in boosting.SUBSETS)
    fall = lambda n, p: f"({p} - {n} * share) * ({p} - {n} * share) / {n}"
    return with_sql(
        """SELECT tag, fold, subset, m.min_split::INTEGER AS min_split, feature::INTEGER AS feature, bin::INTEGER AS bin
            FROM ranked, (SELECT unnest([2, 3]) AS min_split) m WHERE place = 1""",
        signed=HASHED["signed"].replace("% 4096", f"% {ROOT_BUCKETS}"),
        hashed=HASHED["hashed"],
        choice=f"""SELECT s.subset, o.feature FROM (SELECT *, row_number() OVER (ORDER BY h, feature) AS place
            FROM {order_hash}) o JOIN (VALUES {subsets}) s(subset, k) ON o.place <= s.k""",
        train="""SELECT f.tag, g.fold, f.id, f.label FROM folded f
            JOIN (SELECT DISTINCT fold FROM folded) g ON f.fold <> g.fold""",
        totals="SELECT tag, fold, count(*) FILTER (WHERE label) AS p, count(*) AS n FROM train GROUP BY ALL",
        cells=f"""SELECT t.tag, t.fold, c.subset, c.feature, least(coalesce(h.tf, 0), {forest.BINS - 1}) AS bin,
            count(*) FILTER (WHERE label) AS p, count(*) AS n
            FROM train t CROSS JOIN choice c LEFT JOIN hashed h ON h.id = t.id AND h.bucket = c.feature GROUP BY ALL""",
        sides="""SELECT c.tag, c.fold, c.subset, c.feature, c.bin, (sum(c.p) OVER line)::BIGINT AS lp,
            (sum(c.n) OVER line)::BIGINT AS ln_, t.p, t.n, t.p / t.n::DOUBLE AS share FROM cells c JOIN totals t USING (tag, fold)
            WINDOW line AS (PARTITION BY c.tag, c.fold, c.subset, c.feature ORDER BY c.bin)""",
        ranked=f"""SELECT *, row_number() OVER (PARTITION BY tag, fold, subset ORDER BY
            round({fall('ln_', 'lp')} + {fall('(n - ln_)', '(p - lp)')}, 6) DESC, feature, bin) AS place
            FROM sides WHERE ln_ < n""",
    )


def _count_blocks(spark, folder):
    """Blocks of every tag's sample with hashed counts as features, which SQL can state."""
    folded = stage(sampling.stratified_folds(drawn(spark, folder)[1], SPEC), "folds")
    texts = X.sample_texts(folded, document_texts(spark, folder))
    counts = forest.dense_counts(X.hashed_rows(texts, STOP_WORDS, ROOT_BUCKETS), ROOT_BUCKETS)
    return stage(passes.row_blocks(counts.join(folded, "id"), SPEC.rows, SPEC.folds, "u1"), "blocks")


@area.add(_first_splits_sql())
def boosting_first_splits(spark, folder):
    """The first split of the first tree of every setting, on hashed counts."""
    blocks = _count_blocks(spark, folder)
    jobs = boosting.grid(blocks.select("tag").distinct(), SPEC.folds)
    splits = boosting.first_splits(boosting.fit(blocks, jobs, trees=1))
    return splits.where("feature >= 0").withColumn("fold", F.col("fold").cast("long"))


def _all_families(spark, folder):
    blocks, bins, basis, edges = _blocks(spark, folder, "f8", "u1")
    return blocks, bins, basis, edges, families.fold_scores(blocks, bins, lsa.COMPONENTS, SPEC.folds)


@area.add(
    with_sql(
        f"""SELECT tag, {len(families.Grids().families)}::BIGINT AS families, {families.Grids().points}::BIGINT AS points,
            {families.Grids().points * SPEC.folds}::BIGINT AS scores, 1 AS at_floor FROM frequent"""
    )
)
def family_winners(spark, folder):
    """What every tag's winner was chosen from: families, grid points and single-fold scores."""
    *_, scores = _all_families(spark, folder)
    won = families.winners(families.report(scores))
    floor = F.when(F.col("tag").isin(*LANGUAGES), LANGUAGE_FLOOR).otherwise(FLOOR)
    fair = won.select("tag", (F.col("mean_f1") >= floor).cast("int").alias("at_floor"))
    points = F.count_distinct(F.struct("model", *(F.coalesce(F.col(p).cast("string"), F.lit("")).alias(p) for p in families.PARAMS)))
    searched = scores.groupBy("tag").agg(
        F.count_distinct("model").alias("families"), points.alias("points"), F.count("*").alias("scores")
    )
    return searched.join(fair, "tag")


@area.add()
def suggest_with_saved_models(spark, folder):
    """Every question scored with the saved winner of every tag over all families."""
    blocks, bins, basis, edges, scores = _all_families(spark, folder)
    won = families.winners(families.report(scores))
    models = stage(families.refit(won, blocks, bins, lsa.COMPONENTS, SPEC.folds), "tag-models")
    documents = stage(lsa.project(X.hashed_rows(document_texts(spark, folder), STOP_WORDS), basis), "document-features")
    suggested = families.suggest(forest.binned(documents, edges, "bins"), models)
    return suggested.withColumn("tags", F.array_join("tags", " "))
