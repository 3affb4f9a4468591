"""Text features, page assembly and file round trips."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from loomframe.functions.columns import mixed_draw, mixed_key
from loomframe.functions.columns import sentence_tokens as sentence_column
from loomframe.operators import sentences as sn
from loomframe.operators import text as t
from loomframe.operators.baskets import basket_strings
from loomframe.plans.registry import Registry, rounded
from loomframe.plans.views import basket_lines, messages, table, with_views
from loomframe.session import checkpoint_dir
from loomframe.sources import files, tables

plan = Registry()


# Stop words are a parameter; these common ones are used on both sides.
STOP = ("the", "of", "and", "to", "in", "is", "it", "that", "for", "on", "with", "as", "by", "an",
        "at", "from", "are", "this", "be", "or")
STOP_SQL = "(" + ", ".join(f"'{w}'" for w in STOP) + ")"
WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
COUNTS = f"""WITH words AS (SELECT doc_id, unnest({WORDS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM words WHERE term NOT IN {STOP_SQL} GROUP BY ALL),
bag AS (SELECT * FROM counts WHERE term IN
  (SELECT term FROM counts GROUP BY term HAVING count(*) >= 2)),
freq AS (SELECT term, count(*) AS df FROM bag GROUP BY term)"""


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _bag(spark, sf_dir):
    return t.bag_of_words(_docs(spark, sf_dir), "doc_id", "text", STOP)


@plan.add(f"{COUNTS} SELECT * FROM bag")
def bag_of_words(spark, sf_dir):
    return _bag(spark, sf_dir)


@plan.add(f"{COUNTS} SELECT * FROM freq")
def document_frequency(spark, sf_dir):
    return t.document_frequency(_bag(spark, sf_dir))


@plan.add(f"""WITH lexicon AS (SELECT DISTINCT token, left(token, 5) AS base FROM
  (SELECT unnest({WORDS}) AS token FROM benchmark) WHERE length(token) > 5),
words AS (SELECT doc_id, unnest({WORDS}) AS token FROM documents),
counts AS (SELECT doc_id, coalesce(base, token) AS term, count(*) AS tf FROM words
  LEFT JOIN lexicon USING (token) GROUP BY ALL)
SELECT * FROM counts WHERE term IN (SELECT term FROM counts GROUP BY term HAVING count(*) >= 2)""")
def bag_of_words_lexicon(spark, sf_dir):
    # Long words of the benchmark texts and their first letters as the base form.
    long = table(spark, sf_dir, "benchmark").select(
        F.explode(t.tokens(F.col("text"))).alias("token")).filter(F.length("token") > 5)
    lexicon = long.distinct().withColumn("base", F.substring("token", 1, 5))
    return t.bag_of_words(_docs(spark, sf_dir), "doc_id", "text", lexicon=lexicon)


L2 = "round(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 0), 9) AS weight"


@plan.add(f"{COUNTS} SELECT doc_id, term, {L2} FROM (SELECT *, tf::DOUBLE AS w FROM bag)")
def tf_l2(spark, sf_dir):
    return rounded(t.tf_l2(_bag(spark, sf_dir), "doc_id"))


def _idf_sql(plus: str) -> str:
    return f"""{COUNTS}, n AS (SELECT count(*)::DOUBLE AS n FROM documents)
    SELECT doc_id, term, {L2} FROM (SELECT doc_id, term, tf * (ln(n / df) {plus}) AS w
      FROM bag JOIN freq USING (term), n)"""


@plan.add(_idf_sql("+ 1"))
def tfidf_l2(spark, sf_dir):
    n = _docs(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    return rounded(t.tfidf_l2(_bag(spark, sf_dir), "doc_id", n))


@plan.add(_idf_sql(""))
def tfidf_l2_strict(spark, sf_dir):
    n = _docs(spark, sf_dir).agg(F.count(F.lit(1))).scalar()
    return rounded(t.tfidf_l2(_bag(spark, sf_dir), "doc_id", n, strict=True))


def _draw_sql(seed: int) -> str:
    return (f"CAST(concat('0x', substr(md5('{seed}:' || term), 1, 8)) AS BIGINT) "
            "/ 4294967296.0::DOUBLE - 0.5::DOUBLE")


@plan.add(f"""{COUNTS}, known AS (SELECT DISTINCT unnest({WORDS}) AS term FROM benchmark),
vec AS (SELECT term, {_draw_sql(1)} AS a, {_draw_sql(2)} AS b, {_draw_sql(3)} AS c FROM known),
s AS (SELECT doc_id, sum(tf * a) AS a, sum(tf * b) AS b, sum(tf * c) AS c
  FROM bag JOIN vec USING (term) GROUP BY doc_id),
u AS (SELECT *, sqrt(a * a + b * b + c * c) AS l FROM s)
SELECT doc_id, coalesce(round(a / nullif(l, 0), 6), 0) AS v0, coalesce(round(b / nullif(l, 0), 6), 0) AS v1,
  coalesce(round(c / nullif(l, 0), 6), 0) AS v2 FROM documents LEFT JOIN u USING (doc_id)""")
def doc_vectors(spark, sf_dir):
    # The words of the benchmark texts have vectors, drawn from a hash of the word.
    known = table(spark, sf_dir, "benchmark").select(
        F.explode(t.tokens(F.col("text"))).alias("term")).distinct()
    vectors = known.withColumn("vector", F.array(*[
        mixed_draw(mixed_key(F.col("term"), seed)) - 0.5 for seed in (1, 2, 3)]))
    out = t.doc_vectors(_bag(spark, sf_dir), vectors, "doc_id", _docs(spark, sf_dir), 3)
    return rounded(out.select("doc_id", *[F.get("vector", F.lit(i)).alias(f"v{i}")
                                          for i in range(3)]), 6)


@plan.add(r"""WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '[^.!?]+[.!?]*'),
  lambda s: regexp_extract_all(s, '[\p{L}\p{N}'']+')), lambda w: len(w) > 0) AS l FROM documents)
SELECT doc_id, unnest(range(len(l)))::INT AS sentence, unnest(l) AS words FROM s""")
def sentence_tokens(spark, sf_dir):
    return _docs(spark, sf_dir).select(
        "doc_id", F.posexplode(sentence_column(F.col("text"))).alias("sentence", "words"))


#: Tokens, their types and counts, and what is learnt from them. Patterns as in ``sentences``.
TYPED = r"""WITH tok AS (SELECT doc_id, w, generate_subscripts(w, 1) AS i, unnest(w) AS t FROM (SELECT doc_id,
    list_filter(string_split_regex(text, '[\x09-\x0D\x20]+'), lambda x: x <> '') AS w FROM documents)),
typed AS (SELECT *, CASE WHEN regexp_full_match(r, '[0-9][0-9.,]*') THEN '##' ELSE r END AS word, ends_with(c, '.') AND NOT ends_with(c, '..') AS stop
    FROM (SELECT *, lower(regexp_replace(c, '\.$', '')) AS r FROM (SELECT doc_id, i, t, regexp_replace(regexp_replace(t,
        '^["''(\[{«“„]+', ''), '["'')\]}»”,;:!?]+$', '') AS c FROM tok))),
nxt AS (SELECT *, lead(word) OVER o AS next, lead(t) OVER o AS follows FROM typed WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
tot AS (SELECT count(*)::DOUBLE AS n, count(*) FILTER (stop)::DOUBLE AS k FROM typed WHERE word <> ''),
eac AS (SELECT word, count(*)::DOUBLE AS n, count(*) FILTER (stop)::DOUBLE AS k,
    length(word) - length(replace(word, '.', '')) AS inside FROM typed WHERE word <> '' GROUP BY word),
abr AS (SELECT word, CASE WHEN k > 0 AND regexp_matches(word, '[\p{L}#]') THEN -2 * ((k * ln(q) + (n - k) * ln(1 - q))
        - (k * ln(0.99::DOUBLE) + (n - k) * ln(1 - 0.99::DOUBLE))) * exp(-(length(word) - inside + 1.0::DOUBLE)) * (inside + 1)
        * pow(length(word) - inside + 1.0::DOUBLE, k - n) END AS score FROM eac, (SELECT k / n AS q FROM tot)),
aft AS (SELECT next AS word, count(*)::DOUBLE AS m FROM nxt WHERE stop AND word <> '' AND next <> '' AND NOT regexp_full_match(word, '\p{L}')
    AND word NOT IN (SELECT word FROM abr WHERE score >= 0.3::DOUBLE) GROUP BY next),
par AS (SELECT word, m, greatest(n - m, 0) AS o, n, b, t FROM aft JOIN eac USING (word), (SELECT sum(m) AS b FROM aft), (SELECT n AS t FROM tot)),
sta AS (SELECT word, CASE WHEN m / b > n / t THEN 2 * (m * ln(m / b) + CASE WHEN m < b THEN (b - m) * ln(1 - m / b) ELSE 0 END
        + CASE WHEN o > 0 THEN o * ln(o / (t - b)) ELSE 0 END + CASE WHEN o < t - b THEN (t - b - o) * ln(1 - o / (t - b)) ELSE 0 END
        - m * ln(n / t) - (b - m) * ln(1 - n / t) - o * ln(n / t) - (t - b - o) * ln(1 - n / t)) END AS score FROM par),
ends AS (SELECT *, follows IS NULL OR regexp_matches(t, '[!?]["'')\]}»”]*$') OR CASE
    WHEN regexp_matches(t, '(\.\.+|…)["'')\]}»”]*$') THEN capital
    WHEN regexp_matches(t, '\.["'')\]}»”]*$') THEN NOT (word IN (SELECT word FROM abr WHERE score >= 0.3::DOUBLE) OR regexp_full_match(word, '\p{L}'))
        OR capital AND next IN (SELECT word FROM sta WHERE score >= 30 AND regexp_matches(word, '^\p{L}')) ELSE false END AS last
    FROM (SELECT *, regexp_matches(regexp_replace(follows, '^["''(\[{«“„]+', ''), '^\p{Lu}') AS capital FROM nxt)),
"""


@plan.add(TYPED + r"""z AS (SELECT 'abbreviation' AS kind, word, round(score, 6) + 0.0::DOUBLE AS score, coalesce(score >= 0.3::DOUBLE, false) AS chosen FROM abr
    UNION ALL SELECT 'starter', word, round(score, 6) + 0.0::DOUBLE, coalesce(score >= 30 AND regexp_matches(word, '^\p{L}'), false) FROM sta) SELECT * FROM z""")
def sentence_rules(spark, sf_dir):
    """Every word's score as an abbreviation, and as the start of a sentence."""
    rules = sn.learn(_docs(spark, sf_dir), "text")
    kinds = (("abbreviation", rules.abbreviations), ("starter", rules.starters))
    a, b = (rounded(df, 6).select(F.lit(kind).alias("kind"), "word", "score", "chosen") for kind, df in kinds)
    return a.unionByName(b)


@plan.add(TYPED + r"""num AS (SELECT doc_id, i, t, coalesce(sum(last::INT) OVER (PARTITION BY doc_id ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM ends),
cut AS (SELECT doc_id, s, regexp_extract_all(string_agg(t, ' ' ORDER BY i), '[\p{L}\p{N}'']+') AS words FROM num GROUP BY doc_id, s)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1)::INT AS sentence, words FROM cut WHERE len(words) > 0""")
def learnt_sentences(spark, sf_dir):
    return sn.split_sentences(_docs(spark, sf_dir), "text", ["doc_id"])


@plan.add(r"""WITH b AS (SELECT page_id // 25 AS doc, page_id, array_to_string(regexp_extract_all(html,
  '(?s)<div\b[^>]*\bclass="(?:[^"]*\s)?ad(?:\s[^"]*)?"[^>]*>(.*?)</div>', 1), '') AS t FROM pages),
c AS (SELECT doc, page_id, replace(replace(replace(replace(replace(regexp_replace(t,
  '(?s)<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)),
  '&amp;', '&') AS t FROM b)
SELECT doc, string_agg(t, '' ORDER BY page_id) AS text FROM c GROUP BY doc""")
def assemble_pages(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("doc", F.expr("page_id div 25"))
    return files.assemble_pages(pages, "doc", "page_id", "html", "ad")


# -- files: the given tables written and read back ----------------------------

def _new_path(spark) -> str:
    return f"{checkpoint_dir(spark)}/{uuid.uuid4().hex}"


@plan.add("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def read_csv(spark, sf_dir):
    path = _new_path(spark)
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    table(spark, sf_dir, "orders").select(*cols).write.csv(path, header=True, quote='"', escape="\\")
    return files.read_csv(spark, path, "o_orderkey long, o_custkey long, o_totalprice double, "
                                       "o_orderpriority string")


@plan.add(with_views("messages") + "SELECT CAST(id AS VARCHAR) AS id, sender, rcpt, cc, bcc, subject, "
          "date FROM messages")
def read_messages(spark, sf_dir):
    path = _new_path(spark)
    headers = F.struct(F.col("sender").alias("From"), F.col("rcpt").alias("To"),
                       F.col("cc").alias("Cc"), F.col("bcc").alias("X-bcc"),
                       F.col("subject").alias("Subject"), F.col("date").alias("Date"))
    messages(spark, sf_dir).select(F.col("id").cast("string").alias("_id"),
                                   headers.alias("headers")).write.json(path)
    return files.flat_messages(files.read_messages(spark, path))


@plan.add("SELECT CAST(l_quantity AS DOUBLE) AS time, l_extendedprice AS weight FROM lineitem")
def read_pairs(spark, sf_dir):
    path = _new_path(spark)
    table(spark, sf_dir, "lineitem").select(
        F.concat_ws("   ", F.col("l_quantity").cast("string"),
                    F.col("l_extendedprice").cast("string"))).write.text(path)
    return files.read_pairs(spark, path, ["time", "weight"])


@plan.add("SELECT event_id AS id, event_type AS model FROM events")
def read_results(spark, sf_dir):
    path = _new_path(spark)
    tables.append_results(table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("model"), "value"), path)
    return files.read_results(spark, path, "id long, model string, value double", ["id", "model"])


@plan.add("SELECT event_id AS id, event_type AS model, value FROM events WHERE event_id = 7")
def result_by_id(spark, sf_dir):
    path = _new_path(spark)
    tables.append_results(table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("model"), "value"), path)
    return files.result_by_id(spark, path, "id long, model string, value double", "id", 7)


@plan.add("SELECT doc_id AS number, text || chr(10) AS text FROM documents")
def read_corpus(spark, sf_dir):
    # One file per document; each row's text ends with a line end.
    docs = table(spark, sf_dir, "documents").select("text", F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.lit(" - text.txt")).alias("name"))
    folders = files.write_each(docs, "name", "text", _new_path(spark))
    return files.read_corpus(spark, folders).select("number", "text")


@plan.add("""SELECT user_id::BIGINT AS subject_id, event_id::DOUBLE AS timestamp, (event_id % 25)::INT AS activity_id,
  CASE WHEN event_type <> 'error' THEN value::FLOAT END AS heart_rate FROM events""")
def read_sensor_files(spark, sf_dir):
    known = {"timestamp": F.col("event_id").cast("double"), "activity_id": (F.col("event_id") % 25).cast("int"),
             "heart_rate": F.when(F.col("event_type") != "error", F.col("value").cast("float"))}
    line = F.concat_ws(" ", *[F.coalesce(known[c].cast("string"), F.lit("NaN")) if c in known else F.lit("NaN")
                              for c in files.SENSOR_COLUMNS])
    name = F.concat(F.lit("subject="), F.coalesce(F.col("user_id").cast("string"), F.lit("none")), F.lit(".csv"))
    rows = table(spark, sf_dir, "events").select(name.alias("name"), line.alias("line"))
    folders = files.write_each(rows, "name", "line", _new_path(spark))
    return files.read_sensor_files(spark, folders, "heart", subject=r"subject=(\d+)\.csv$")


@plan.add("""SELECT event_type, count(*) FILTER (event_id % 3 = 0) AS c0, count(*) FILTER (event_id % 3 = 1) AS c1,
  count(*) FILTER (event_id % 3 = 2) AS c2 FROM events GROUP BY event_type""")
def save_matrix(spark, sf_dir):
    path = _new_path(spark)
    counts = table(spark, sf_dir, "events").groupBy("event_type", (F.col("event_id") % 3).alias("guess")).count()
    tables.save_matrix(counts, "event_type", "guess", [0, 1, 2], path)
    return spark.read.schema("event_type string, c0 long, c1 long, c2 long").csv(path, sep=" ", header=True,
                                                                                 enforceSchema=True)


@plan.add("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def stage(spark, sf_dir):
    folder = _new_path(spark)
    tables.stage(spark, lambda: table(spark, sf_dir, "orders"), "orders", folder)
    return tables.stages(spark, {
        "orders": lambda _: table(spark, sf_dir, "orders"),
        "counts": lambda df: df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")),
    }, folder)


@plan.add("SELECT conv_id, turn, role FROM conversations WHERE role = 'user' "
          "UNION ALL SELECT conv_id, turn, role FROM conversations WHERE role <> 'user'")
def save_table(spark, sf_dir):
    name, path = f"turns_{uuid.uuid4().hex}", _new_path(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    tables.save_table(turns.filter("role = 'user'"), name, "create", path)
    tables.save_table(turns.filter("role <> 'user'"), name, "append", path)
    return spark.table(name)


@plan.add(with_views("b_op") + """SELECT order_id, coalesce(string_agg(CASE WHEN reordered = 1 THEN
  CAST(product_id AS VARCHAR) END, ' ' ORDER BY product_id), '') AS products
FROM b_op WHERE source <> 'prior' GROUP BY order_id""")
def save_submission(spark, sf_dir):
    path = _new_path(spark)
    recent = basket_lines(spark, sf_dir).filter("source <> 'prior'")
    tables.save_submission(basket_strings(recent.withColumn("order", F.col("reordered"))), path)
    return files.read_csv(spark, path, "order_id long, products string").na.fill("", ["products"])


@plan.add("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events
GROUP BY event_type""")
def save_scores(spark, sf_dir):
    path = _new_path(spark)
    scores = table(spark, sf_dir, "events").groupBy("event_type").agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean")).alias("scores"))
    tables.save_scores(scores, path)
    back = spark.read.schema("event_type string, scores struct<n: long, mean: double>").json(path)
    return rounded(back.select("event_type", "scores.n", "scores.mean"), 6)
