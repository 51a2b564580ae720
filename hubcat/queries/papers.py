"""Papers: taxonomy, term vectors, best matches, labels and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hubcat.functions.vectors import cosine
from hubcat.operators import matching as m
from hubcat.operators import reports
from hubcat.operators.labels import keyword_terms, with_taxonomy
from hubcat.operators.skew import join_unique
from hubcat.operators.taxonomy import level_counts, taxonomy_from_paths
from hubcat.plans.papers import labelled_papers, papers_table
from hubcat.session import scratch_path
from hubcat.sources.sinks import write_report
from hubcat.queries.models import STAMP
from hubcat.queries.mapping import (ALPHABET, PAPER_ROWS, SIMILARITY, mapped, strip_sql, table, dealt)

NODE_SIMILARITY = 0.3
_LISTED = ("taxonomy_categories", "taxonomy_subcategories", "taxonomy_topics")


def papers(spark: SparkSession, sf: str) -> DataFrame:
    rows = dealt(spark, sf, "documents", "doc_id", "text", "lang", "source", "n_chars")
    return mapped(rows, PAPER_ROWS).withColumn(
        "paper_ai_keywords", F.split("text", " ", -1)).drop("text")


def nodes(spark: SparkSession, sf: str) -> DataFrame:
    return taxonomy_from_paths(table(spark, sf, "part").selectExpr(
        "p_type as category", "p_brand as subcategory", "p_name as topic"))


def letters(c: Column) -> Column:
    """How often each letter occurs in a text."""
    low = F.lower(c)
    return F.array(*(
        (F.length(low) - F.length(F.replace(low, F.lit(x), F.lit("")))).cast("double")
        for x in ALPHABET))


def letter_vectors(terms: DataFrame) -> DataFrame:
    """(token, vector) for every token of the terms."""
    return m.tokens(terms, lowercase=True).select("token").distinct().select(
        "token", letters(F.col("token")).alias("vector"))


_WRITTEN: dict[tuple[str, str], str] = {}


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The word-vector table of the documents' and nodes' words: an input of the plans, so a session writes it once."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        path = scratch_path(spark, "word-vectors")
        words = keyword_terms(papers(spark, sf))
        letter_vectors(words.unionByName(nodes(spark, sf).select(F.col("label").alias("term")))).write.parquet(path)
        _WRITTEN[key] = path
    return spark.read.parquet(_WRITTEN[key])


def matches(found: DataFrame, tree: DataFrame, **limits: int) -> DataFrame:
    """Keyword matches from term vectors made straight from the terms.

    Counting letters over a term or averaging them over its words gives the same direction.
    """
    vectors = keyword_terms(found).select("term", letters(F.col("term")).alias("vector"))
    return m.best_matches(vectors, tree.withColumn("vector", letters(F.col("label"))), SIMILARITY, **limits)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    found = papers(spark, sf)
    return with_taxonomy(found, matches(found, nodes(spark, sf)))


def labelled_by_words(spark: SparkSession, sf: str) -> DataFrame:
    """The complete plan: word vectors, term means, matches, labels."""
    found, tree = papers(spark, sf), nodes(spark, sf)
    return labelled_papers(found, tree, word_vectors(spark, sf), threshold=SIMILARITY,
                           lowercase=True)


def e1_taxonomy(spark, sf):
    return nodes(spark, sf).select(
        "ordinal", "category", "subcategory", "topic", "label", "level",
        F.array_join("path", "|").alias("path"))


def a15_level_counts(spark, sf):
    return level_counts(nodes(spark, sf))


def e2_term_vectors(spark, sf):
    return _vector_digest(dealt(spark, sf, "conversations", "text").withColumnRenamed("text", "term"))


def _vector_digest(terms: DataFrame) -> DataFrame:
    vectors = m.term_vectors(terms, letter_vectors(terms), lowercase=True)
    spread = F.aggregate(F.transform("vector", lambda v, i: v * F.sqrt(i + 1)), F.lit(0.0),
                         lambda total, v: total + v)
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, v: total + v * v))
    return vectors.select(F.md5("term").alias("term_md5"), F.round(length, 6).alias("length"),
                          F.round(spread, 6).alias("spread"))


def _embedding_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vectors per label, and per label and the signs of its first two values."""
    sign = "case when embedding[{0}] < 0 then '-' else '+' end"
    rows = table(spark, sf, "embeddings").selectExpr(
        "'c' || cast(label as string) as category",
        f"'c' || cast(label as string) || {sign.format(0)} as subcategory",
        f"'c' || cast(label as string) || {sign.format(0)} || {sign.format(1)} as topic",
        "cast(embedding as array<double>) as embedding")
    named = rows.select(F.explode(F.array("category", "subcategory", "topic")).alias("label"),
                        "embedding").select("label", F.posexplode("embedding").alias("dim", "value"))
    # A label may hold a third of all rows: average per value, with a partial sum first.
    values = named.groupBy("label", "dim").agg(F.round(F.avg("value"), 9).alias("value"))
    means = values.groupBy("label").agg(
        F.array_sort(F.collect_list(F.struct("dim", "value"))).alias("v")).select(
        "label", F.transform("v", lambda x: x["value"]).alias("vector"))
    return taxonomy_from_paths(rows.select("category", "subcategory", "topic")).join(means, "label")


def e3_cosine(spark, sf):
    means = _embedding_nodes(spark, sf).where("level = 'category'").select(
        "category", F.col("vector").alias("mean"))
    rows = table(spark, sf, "embeddings").withColumn(
        "category", F.concat(F.lit("c"), F.col("label").cast("string")))
    return join_unique(rows, means, "category", "inner").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("mean")), 6).alias("similarity"))


def x1_vector_match(spark, sf):
    terms = table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("term"), F.col("embedding").alias("vector"))
    found = m.best_matches(terms, _embedding_nodes(spark, sf), NODE_SIMILARITY)
    return found.select("term", "ordinal", "label", "level", F.round("score", 6).alias("score"))


def e4_best_match(spark, sf):
    out = matches(papers(spark, sf), nodes(spark, sf))
    return out.select("term", "ordinal", "label", "level", F.round("score", 6).alias("score"))


def e4_blocked_match(spark, sf):
    """The same without a broadcast of the nodes, with all node fields."""
    out = matches(papers(spark, sf), nodes(spark, sf), broadcast_nodes=0)
    return out.select("term", "ordinal", "category", "subcategory", "topic", "label", "level", F.round("score", 6).alias("score"))


def e2_text_vectors(spark, sf):
    """Term vectors of whole documents: a term may be as long as a text."""
    return _vector_digest(dealt(spark, sf, "documents", "text").withColumnRenamed("text", "term"))


def _labels(out: DataFrame, *extra) -> DataFrame:
    return out.select(
        "paper_id", *extra, *(F.array_join(c, "|").alias(c) for c in _LISTED),
        "primary_category", "primary_subcategory", "primary_topic",
        F.round(F.try_element_at("topic_scores", F.col("primary_topic")), 6).alias("topic_score"),
        F.size("category_scores").alias("n_categories"))


def e6_multilabel(spark, sf):
    return _labels(labelled(spark, sf))


def e8_labelled_papers(spark, sf):
    return _labels(labelled_by_words(spark, sf))


def m3_papers_table(spark, sf):
    """The finished table from a raw dump, by its parts that SQL can tell."""
    raw = dealt(spark, sf, "documents", "doc_id", "text", "lang", "source", "n_chars").selectExpr(
        "cast(doc_id as string) as paper_id", "lang || ' ' || source as paper_title", "cast(n_chars as string) as paper_upvotes",
        "named_struct('name', '', 'fullname', source, '_id', lang) as organization", "split(text, ' ', -1) as paper_ai_keywords",
        "lang as `paper_organization.name`", "'2025-01-02T03:04:05Z' as publishedAt", "'x' as card")
    tree = nodes(spark, sf)
    out = papers_table(raw, STAMP, tree, word_vectors(spark, sf), threshold=SIMILARITY, lowercase=True)
    return _labels(out, "paper_title", "paper_upvotes", "organization_name", F.col("`paper_organization.name`").alias("org"),
                   F.unix_seconds("publishedAt").alias("published"), F.lit(len(out.columns)).alias("n_columns"),
                   (F.col("citation_count").isNull() & F.col("paper_withdrawnAt").isNull()).alias("empty"))


def e7_match_details(spark, sf):
    details = F.col("matched_keywords_details")
    pairs = F.transform(details, lambda d: F.concat_ws(":", d["keyword"], d["matched_to"], d["match_level"]))
    return labelled(spark, sf).select(
        "paper_id", F.size(details).alias("matches"),
        F.md5(F.array_join(pairs, ",")).alias("details_md5"))


def a8_label_counts(spark, sf):
    found = labelled(spark, sf)
    return reports.label_distribution(found, "primary_topic", 50).withColumn(
        "percent", F.round("percent", 6))


def a9_coverage(spark, sf):
    out = reports.coverage(labelled(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in (
        "coverage_percent", "multi_category_percent", "mean_categories")})


def a10_match_stats(spark, sf):
    return reports.match_stats(labelled(spark, sf)).withColumn("mean_score", F.round("mean_score", 6))


def a13_summary(spark, sf):
    found = labelled(spark, sf).withColumn("citation_count", F.col("paper_upvotes"))
    return _summary(reports.distribution_summary(found))


def s12_report(spark, sf):
    """The same report, written as JSON and read back with its own schema."""
    report = reports.distribution_summary(labelled(spark, sf).withColumn("citation_count", F.col("paper_upvotes")))
    path = scratch_path(spark, "report")
    write_report(report, path)
    return _summary(spark.read.schema(report.schema).json(path))


def _summary(row: DataFrame) -> DataFrame:
    def text(c):
        return F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws(":", e["key"], e["value"])), "|")

    return row.select(
        "total_papers", "classified_papers", F.round("coverage_percentage", 6).alias("coverage_percentage"),
        F.col("multi_classification.multi_category_papers").alias("multi_category_papers"),
        F.round("multi_classification.multi_category_percentage", 6).alias("multi_percentage"),
        F.round("multi_classification.average_categories_per_paper", 6).alias("mean_categories"),
        F.col("citation_statistics.papers_with_citations").alias("cited"),
        F.round("citation_statistics.average_citations", 4).alias("mean_citations"),
        F.round("match_statistics.average_score", 6).alias("mean_score"),
        F.col("citation_statistics.total_citations").alias("total_citations"),
        text("category_distribution").alias("categories"),
        text("subcategory_distribution").alias("subcategories"),
        text("topic_distribution").alias("topics"),
        F.col("match_statistics.total_matches").alias("total_matches"),
        text("match_statistics.matches_by_level").alias("levels"))


def r9_classified_sample(spark, sf):
    return reports.classified_sample(labelled(spark, sf)).select("paper_id", "primary_category")


QUERIES = {f.__name__: f for f in (
    e1_taxonomy, a15_level_counts, e2_term_vectors, e3_cosine, x1_vector_match, e4_best_match,
    e4_blocked_match, e2_text_vectors,
    e6_multilabel, e8_labelled_papers, m3_papers_table, e7_match_details, a8_label_counts, a9_coverage, a10_match_stats, a13_summary, s12_report,
    r9_classified_sample)}

# ---------------------------------------------------------------- DuckDB side

_ORDINALS = """row_number() over (order by category, subcategory nulls first, topic nulls first) - 1
  as ordinal, category, subcategory, topic, coalesce(topic, subcategory, category) as label,
  case when topic is not null then 'topic' when subcategory is not null then 'subcategory'
  else 'category' end as level"""


def _nodes(paths: str) -> str:
    return f"""paths as ({paths}),
    nodes as (select {_ORDINALS} from (
      select category, null::varchar as subcategory, null::varchar as topic from paths
      union select category, subcategory, null::varchar from paths
      union select category, subcategory, topic from paths))"""


def _letters(text: str) -> str:
    alphabet = ", ".join(f"'{c}'" for c in ALPHABET)
    return (f"list_transform([{alphabet}], lambda c: (length(lower({text})) - "
            f"length(replace(lower({text}), c, '')))::double)")


_PART_NODES = _nodes("select distinct p_type as category, p_brand as subcategory, "
                     "p_name as topic from part")
_MATCHES = f"""{_PART_NODES},
words as (select cast(doc_id as varchar) as paper_id, unnest(string_split(text, ' ')) as w,
    generate_subscripts(string_split(text, ' '), 1) as pos from documents),
kw as (select paper_id, pos, w as term from words),
tv as (select term, {_letters('term')} as vector from (select distinct term from kw)),
nv as (select label, min(ordinal) as ordinal, {_letters('label')} as vector from nodes group by label),
pairs as (select term, nv.ordinal, round(list_cosine_similarity(tv.vector, nv.vector), 12) as sim
    from tv, nv where list_sum(tv.vector) > 0),
best as (select term, arg_max(ordinal, (sim, -ordinal)) as ordinal, max(sim) as score
    from pairs where sim > {SIMILARITY} group by term),
matches as (select best.term, best.score, nodes.* from best join nodes using (ordinal)),
hits as (select kw.paper_id, kw.pos, matches.* from kw join matches using (term))"""
_LABELS = f"""{_MATCHES},
levels as (
  select paper_id, 'category' as kind, category as name, score, pos from hits
  union all select paper_id, 'subcategory', subcategory, score, pos from hits where subcategory is not null
  union all select paper_id, 'topic', topic, score, pos from hits where topic is not null),
scored as (select paper_id, kind, name, max(score) as score, min(pos) as pos from levels group by all),
ranked as (select *, row_number() over (partition by paper_id, kind order by score desc, pos) as rn,
    max(score) over (partition by paper_id, kind) as top from scored),
kept as (select * from ranked where score >= top * 0.9::double and rn <= 5),
lists as (select paper_id, kind, string_agg(name, '|' order by rn) as names,
    max(case when rn = 1 then name end) as first_name, max(case when rn = 1 then score end) as score,
    count(*) as n from kept group by all),
papers as (select cast(doc_id as varchar) as paper_id, n_chars from documents),
labelled as (select p.paper_id, p.n_chars, coalesce(c.names, '') as taxonomy_categories,
    coalesce(s.names, '') as taxonomy_subcategories, coalesce(t.names, '') as taxonomy_topics,
    c.first_name as primary_category, s.first_name as primary_subcategory,
    t.first_name as primary_topic, t.score as topic_score, coalesce(c.n, 0) as n_categories
  from papers p
  left join lists c on c.paper_id = p.paper_id and c.kind = 'category'
  left join lists s on s.paper_id = p.paper_id and s.kind = 'subcategory'
  left join lists t on t.paper_id = p.paper_id and t.kind = 'topic')"""
_DIMS = "64"
_SIGN = "case when embedding[{0}] < 0 then '-' else '+' end"
_VECTOR_NODES = _nodes(f"""select distinct 'c' || label as category,
      'c' || label || {_SIGN.format(1)} as subcategory,
      'c' || label || {_SIGN.format(1)} || {_SIGN.format(2)} as topic from embeddings""") + f""",
long as (select 'c' || label as category, 'c' || label || {_SIGN.format(1)} as subcategory,
    'c' || label || {_SIGN.format(1)} || {_SIGN.format(2)} as topic,
    unnest(embedding)::double as value, generate_subscripts(embedding, 1) as dim from embeddings),
named as (select category as label, value, dim from long union all
    select subcategory, value, dim from long union all select topic, value, dim from long),
means as (select label, dim, round(avg(value), 9) as value from named group by all),
nv as (select label, list(value order by dim) as vector from means group by label)"""


def _distribution(column: str, k: int) -> str:
    return f"""(select string_agg(v || ':' || n, '|' order by n desc, v) from (
      select {column} as v, count(*) as n from labelled where {column} is not null group by 1
      order by n desc, v limit {k}))"""


ORACLE = {
    "e1_taxonomy": f"""with {_PART_NODES} select *,
        concat_ws('|', category, subcategory, topic) as path from nodes""",
    "a15_level_counts": f"with {_PART_NODES} select level, count(*) as nodes from nodes group by level",
    "e2_term_vectors": rf"""with t as (select distinct text as term from conversations),
        v as (select term, {_letters('term')} as vector,
          len(list_filter(string_split_regex(lower(term), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')) as n
          from t),
        means as (select term, list_transform(vector, lambda x: x / n) as vector from v where n > 0)
        select md5(term) as term_md5,
          round(sqrt(list_sum(list_transform(vector, lambda x: x * x))), 6) as length,
          round(list_sum(list_transform(vector, lambda x, i: x * sqrt(i))), 6) as spread from means""",
    "e3_cosine": f"""with {_VECTOR_NODES} select vec_id, round(list_cosine_similarity(
        e.embedding::double[], nv.vector), 6) as similarity
        from embeddings e join nv on nv.label = 'c' || e.label""",
    "x1_vector_match": f"""with {_VECTOR_NODES},
        pairs as (select cast(vec_id as varchar) as term, n.ordinal, n.label, n.level,
          round(list_cosine_similarity(e.embedding::double[], nv.vector), 12) as sim
          from embeddings e, nodes n join nv on nv.label = n.label)
        select term, arg_max(ordinal, (sim, -ordinal)) as ordinal,
          arg_max(label, (sim, -ordinal)) as label, arg_max(level, (sim, -ordinal)) as level,
          round(max(sim), 6) as score from pairs where sim > {NODE_SIMILARITY} group by term""",
    "e4_best_match": f"""with {_MATCHES} select term, ordinal, label, level,
        round(score, 6) as score from matches""",
    "e6_multilabel": f"""with {_LABELS} select paper_id, taxonomy_categories,
        taxonomy_subcategories, taxonomy_topics, primary_category, primary_subcategory,
        primary_topic, round(topic_score, 6) as topic_score, n_categories::integer as n_categories
        from labelled""",
    "e7_match_details": f"""with {_MATCHES}, d as (select paper_id, count(*) as n, string_agg(
          {strip_sql('term')} || ':' || label || ':' || level, ',' order by pos) as details from hits group by 1)
        select cast(doc_id as varchar) as paper_id, coalesce(n, 0)::integer as matches,
          md5(coalesce(details, '')) as details_md5
        from documents left join d on d.paper_id = cast(doc_id as varchar)""",
    "a8_label_counts": f"""with {_LABELS} select primary_topic as label, count(*) as rows,
        round(count(*) * 100.0::double / (select count(*) from labelled), 6) as percent
        from labelled where primary_topic is not null group by 1 order by rows desc, label limit 50""",
    "a9_coverage": f"""with {_LABELS} select count(*) as total_papers,
        count(primary_category) as classified, count(*) - count(primary_category) as unclassified,
        round(count(primary_category) * 100.0::double / count(*), 6) as coverage_percent,
        count(*) filter (n_categories > 1) as multi_category,
        round(count(*) filter (n_categories > 1) * 100.0::double / count(*), 6) as multi_category_percent,
        round(avg(n_categories), 6) as mean_categories from labelled""",
    "a10_match_stats": f"""with {_MATCHES} select level as match_level, count(*) as matches,
        round(avg(score), 6) as mean_score from hits group by rollup (level)""",
    "a13_summary": f"""with {_LABELS} select count(*) as total_papers,
        count(primary_category) as classified_papers,
        round(count(primary_category) * 100.0::double / count(*), 6) as coverage_percentage,
        count(*) filter (n_categories > 1) as multi_category_papers,
        round(count(*) filter (n_categories > 1) * 100.0::double / count(*), 6) as multi_percentage,
        round(avg(n_categories), 6) as mean_categories, count(n_chars) as cited, round(avg(n_chars), 4) as mean_citations,
        (select round(avg(score), 6) from hits) as mean_score,
        sum(n_chars)::bigint as total_citations, {_distribution('primary_category', 20)} as categories,
        {_distribution('primary_subcategory', 30)} as subcategories,
        {_distribution('primary_topic', 50)} as topics,
        (select count(*) from hits) as total_matches,
        (select string_agg(level || ':' || n, '|' order by level) from (
          select level, count(*) as n from hits group by 1)) as levels
        from labelled""",
    "r9_classified_sample": f"""with {_LABELS} select paper_id, primary_category from labelled
        where primary_category is not null order by paper_id limit 3""",
}

ORACLE["s12_report"] = ORACLE["a13_summary"]
ORACLE["m3_papers_table"] = f"""with {_LABELS} select l.paper_id, taxonomy_categories, taxonomy_subcategories,
    taxonomy_topics, primary_category, primary_subcategory, primary_topic, round(topic_score, 6) as topic_score,
    n_categories::integer as n_categories, d.lang || ' ' || d.source as paper_title, d.n_chars::double as paper_upvotes,
    d.source as organization_name, d.lang as org, 1735787045::bigint as published, 48::integer as n_columns, true as empty
    from labelled l join documents d on cast(d.doc_id as varchar) = l.paper_id"""
ORACLE["e2_text_vectors"] = ORACLE["e2_term_vectors"].replace("from conversations", "from documents where text is not null")
ORACLE["e4_blocked_match"] = f"""with {_MATCHES} select term, ordinal, category, subcategory, topic, label, level,
    round(score, 6) as score from matches"""
ORACLE["e8_labelled_papers"] = ORACLE["e6_multilabel"]
