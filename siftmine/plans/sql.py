"""The registered queries as plain SQL over the given tables."""

from __future__ import annotations

# Parameters shared by the queries and their SQL.
EVENT_SHARE = 0.05  # support as share of the baskets, so that it grows with the data
ORDER_SHARE = 0.004
EVENT_TYPES = 5
K = 8
ITERS = 3
SEED = 7
CLUSTERS, CLUSTER_ITERS, TERMS = 5, 20, 32
SAMPLE = 100
BITS = 1024
PREFIX = "th"
NEIGHBOURS = 10
BATCHES = 4
TIMED_BATCHES = 2
PARTITIONS = 7

SURVEY = """
survey AS (
  SELECT c_custkey AS respondent,
    CASE WHEN c_custkey % 5 = 0
      THEN substr(n_name, 1, 2) || ',' || substr(n_name, 3) ELSE n_name END AS country,
    CASE WHEN c_custkey % 17 = 0 THEN 'NA'
      WHEN c_custkey % 19 = 0 THEN '0'
      WHEN c_custkey % 23 = 0 THEN NULL
      WHEN c_custkey % 29 = 0 THEN 'abc'
      WHEN c_custkey % 31 = 0 THEN CAST(x AS VARCHAR) || '000000'
      WHEN x >= 1000 THEN CAST(CAST(floor(x / 1000) AS BIGINT) AS VARCHAR) || ','
        || lpad(CAST(x % 1000 AS VARCHAR), 3, '0')
      ELSE CAST(x AS VARCHAR) END AS salary,
    CASE c_custkey % 4 WHEN 0 THEN 'Monthly' WHEN 1 THEN 'Weekly' WHEN 2 THEN 'Yearly' END
      AS salary_type
  FROM (SELECT *, CAST(floor(abs(c_acctbal)) AS BIGINT) AS x FROM customer) c
  JOIN nation ON c_nationkey = n_nationkey)"""

YEARLY = f"""{SURVEY},
yearly AS (
  SELECT respondent, country, salary_type,
    TRY_CAST(replace(salary, ',', '') AS DOUBLE)
      * CASE salary_type WHEN 'Monthly' THEN 12 WHEN 'Weekly' THEN 52 ELSE 1 END AS salary
  FROM survey WHERE salary NOT IN ('NA', '0'))"""

RATINGS = """
ratings AS (
  SELECT o_custkey AS "user", l_partkey AS item,
    avg(1.0e0 + CAST(l_quantity AS INTEGER) % 5) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)"""

SPLIT = f"""{RATINGS},
train AS (SELECT * FROM ratings WHERE ("user" * 7 + item * 3) % 10 <> 0),
test AS (SELECT * FROM ratings WHERE ("user" * 7 + item * 3) % 10 = 0)"""

DEVIATIONS = f"""{SPLIT},
im AS (SELECT item, avg(rating) AS mean FROM train GROUP BY item),
um AS (SELECT "user", avg(rating) AS mean, count(*) AS n FROM train GROUP BY "user"),
dev AS (
  SELECT "user", item, round(rating - mean, 9) + 0.0e0 AS dev FROM train JOIN im USING (item))"""

PAIRS = f"""{DEVIATIONS},
sums AS (
  SELECT a.item AS item_a, b.item AS item_b, sum(a.dev * b.dev) AS ab,
    sqrt(sum(a.dev * a.dev)) * sqrt(sum(b.dev * b.dev)) AS norm, count(*) AS n_common
  FROM dev a JOIN dev b ON a."user" = b."user" AND a.item < b.item GROUP BY ALL),
sims AS (
  SELECT item_a, item_b,
    CASE WHEN norm = 0 THEN 0 ELSE round(ab / norm, 9) + 0.0e0 END AS sim, n_common
  FROM sums)"""


def _cf(weight: str) -> str:
    return f"""{PAIRS},
both_ways AS (
  SELECT item_a AS item, item_b AS neighbour, sim FROM sims
  UNION ALL SELECT item_b, item_a, sim FROM sims),
ranked AS (
  SELECT t."user", t.item, d.dev, s.sim, um.n,
    row_number() OVER (PARTITION BY t."user", t.item ORDER BY s.sim DESC, s.neighbour) AS rn
  FROM test t JOIN dev d ON t."user" = d."user"
  JOIN both_ways s ON s.item = t.item AND s.neighbour = d.item
  JOIN um ON um."user" = t."user"),
ratio AS (
  SELECT "user", item, sum(dev * sim) AS num, round(sum({weight}), 9) AS den FROM ranked
  WHERE rn <= greatest(1, least({NEIGHBOURS}, n - 1)) GROUP BY ALL),
devs AS (
  SELECT "user", item,
    CASE WHEN den <> 0 AND abs(num / den) <= 1 THEN num / den ELSE 0 END AS d FROM ratio),
predicted AS (
  SELECT t."user", t.item, t.rating, im.mean AS im, um.mean AS um,
    CASE WHEN im.mean IS NOT NULL AND um.mean IS NOT NULL THEN coalesce(d, 0) END AS pred_dev
  FROM test t LEFT JOIN im USING (item) LEFT JOIN um ON um."user" = t."user"
  LEFT JOIN devs ON devs."user" = t."user" AND devs.item = t.item),
cf AS (
  SELECT "user", item, round(rating, 4) AS rating, round(pred_dev, 4) + 0.0e0 AS pred_dev,
    round(coalesce(im + coalesce(pred_dev, 0), um, 2.5), 4) AS pred_rating
  FROM predicted)"""


CF_ABS, CF_SIGNED = _cf("abs(sim)"), _cf("sim")


def _als(rank: int, iters: int, reg: float, seed: int = 0) -> str:
    """CTE ``als`` with the predictions after ``iters`` iterations of rank 2."""
    assert rank == 2
    start = ", ".join(
        f"(CAST('0x' || substr(md5(item || '-{seed}-{i}'), 1, 8) AS BIGINT) % 1000000 + 1) / 1e6 AS f{i}"
        for i in range(rank)
    )
    steps = [f"{SPLIT},\ni0 AS MATERIALIZED (SELECT item, {start} FROM (SELECT DISTINCT item FROM train))"]

    def half(name: str, key: str, other: str, before: str) -> str:
        return f"""
{name} AS MATERIALIZED (
  SELECT {key}, (c * r0 - b * r1) / (a * c - b * b) AS f0, (a * r1 - b * r0) / (a * c - b * b) AS f1
  FROM (SELECT {key}, sum(f0 * f0) + CAST({reg} AS DOUBLE) * count(*) AS a, sum(f0 * f1) AS b,
      sum(f1 * f1) + CAST({reg} AS DOUBLE) * count(*) AS c,
      sum(rating * f0) AS r0, sum(rating * f1) AS r1
    FROM train JOIN {before} USING ({other}) GROUP BY {key}))"""

    for i in range(1, iters + 1):
        steps.append(half(f"u{i}", '"user"', "item", f"i{i - 1}"))
        steps.append(half(f"i{i}", "item", '"user"', f"u{i}"))
    steps.append(f"""
als AS (
  SELECT "user", item, rating, u.f0 * i.f0 + u.f1 * i.f1 AS prediction
  FROM test JOIN u{iters} u USING ("user") JOIN i{iters} i USING (item))""")
    return ",".join(steps)


ALS = _als(2, 25, 0.28)


def _histogram(source: str, error: str) -> str:
    return f"""e AS (
        SELECT CAST(least(floor({error}), 4) AS INTEGER) AS bucket FROM {source})
      SELECT b.bucket, b.label, count(e.bucket) AS n
      FROM (VALUES (0, '[0,1)'), (1, '[1,2)'), (2, '[2,3)'), (3, '[3,4)'), (4, '[4,inf)'))
        b(bucket, label) LEFT JOIN e USING (bucket) GROUP BY ALL"""

EVENT_BASKETS = """
rows AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) || '|' || strftime(ts, '%Y-%m-%d') AS basket,
    event_type AS item FROM events)"""

ORDER_BASKETS = """
rows AS (
  SELECT DISTINCT l_orderkey AS basket, 'p' || CAST(l_partkey % 50 AS VARCHAR) AS item
  FROM lineitem)"""


def _itemsets(baskets: str, share: float, sizes: range) -> str:
    """CTE ``found`` with all itemsets of the given sizes."""
    support = f"(SELECT ceil(count(DISTINCT basket) * CAST({share} AS DOUBLE)) FROM rows)"
    parts = []
    for size in sizes:
        names = [f"r{i}" for i in range(1, size + 1)]
        joins = "".join(
            f" JOIN rows {b} ON {a}.basket = {b}.basket AND {a}.item < {b}.item"
            for a, b in zip(names, names[1:])
        )
        joined = " || ',' || ".join(f"{name}.item" for name in names)
        parts.append(
            f"SELECT {joined} AS items, {size} AS size, count(*) AS freq "
            f"FROM rows r1{joins} GROUP BY 1 HAVING count(*) >= {support}"
        )
    return f"{baskets},\nfound AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


EVENT_ITEMSETS = _itemsets(EVENT_BASKETS, EVENT_SHARE, range(1, EVENT_TYPES + 1))
ORDER_ITEMSETS = _itemsets(ORDER_BASKETS, ORDER_SHARE, range(1, 4))

TOKENS = """
tokens AS (
  SELECT doc_id, lang, CASE WHEN body = '' AND text <> '' THEN CAST([] AS VARCHAR[])
    ELSE string_split(body, ' ') END AS tokens
  FROM (SELECT doc_id, lang, text, rtrim(replace(text, chr(10), ' '), ' ') AS body
        FROM documents))"""

VECTORS = """
vectors AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"""

def _seeds(vectors: str, k: int) -> str:
    return f"""{vectors},
seeds AS (
  SELECT CAST(row_number() OVER (ORDER BY k, vec_id) - 1 AS INTEGER) AS cluster, vec_id, x
  FROM (
    SELECT vec_id, x, k, row_number() OVER (PARTITION BY x ORDER BY k, vec_id) AS copy
    FROM (SELECT vec_id, x, md5(CAST(vec_id AS VARCHAR) || '-{SEED}') AS k FROM vectors))
  WHERE copy = 1 ORDER BY k, vec_id LIMIT {k})"""


SEEDS = _seeds(VECTORS, K)


def _assign(name: str, centres: str) -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT vec_id, x, cluster, d FROM (
    SELECT v.vec_id, v.x, c.cluster, pow(list_distance(v.x, c.x), 2) AS d,
      row_number() OVER (PARTITION BY v.vec_id
        ORDER BY round(pow(list_distance(v.x, c.x), 2), 9), c.cluster) AS rn
    FROM vectors v CROSS JOIN {centres} c)
  WHERE rn = 1)"""


def _update(name: str, assigned: str, centres: str) -> str:
    return f"""
{name}_cells AS (
  SELECT cluster, dim, avg(value) AS value, count(*) AS n FROM (
    SELECT cluster, unnest(range(len(x))) AS dim, unnest(x) AS value FROM {assigned})
  GROUP BY cluster, dim),
{name} AS MATERIALIZED (
  SELECT c.cluster, coalesce(u.x, c.x) AS x, coalesce(u.n, 0) AS n FROM {centres} c LEFT JOIN (
    SELECT cluster, list(value ORDER BY dim) AS x, max(n) AS n
    FROM {name}_cells GROUP BY cluster) u USING (cluster))"""


ASSIGNED = f"{SEEDS},{_assign('assigned', 'seeds')}"


def _lloyd(seeds: str, iters: int) -> str:
    steps, centres = [seeds], "seeds"
    for i in range(1, iters + 1):
        steps += [_assign(f"a{i}", centres), _update(f"c{i}", f"a{i}", centres)]
        centres = f"c{i}"
    return ",".join([*steps, _assign("final", centres)])


def _terms_report(weight: str) -> str:
    """The report of K-Means on the counts of the most frequent terms."""
    vectors = f"""{TOKENS},
vocabulary AS MATERIALIZED (
  SELECT term, row_number() OVER (ORDER BY df DESC, term) - 1 AS place,
    ln(((SELECT count(*) FROM tokens) + 1) / (df + 1)) AS idf
  FROM (SELECT term, count(*) AS df FROM (
      SELECT unnest(list_distinct(tokens)) AS term FROM tokens) GROUP BY term)
  ORDER BY df DESC, term LIMIT {TERMS}),
counts AS (
  SELECT doc_id, place, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM tokens)
  JOIN vocabulary USING (term) GROUP BY ALL),
vectors AS MATERIALIZED (
  SELECT doc_id AS vec_id, list(coalesce(n, 0) * CAST({weight} AS DOUBLE) ORDER BY place) AS x
  FROM (SELECT doc_id, place, idf FROM tokens CROSS JOIN vocabulary)
  LEFT JOIN counts USING (doc_id, place) GROUP BY doc_id)"""
    return f"""WITH {_lloyd(_seeds(vectors, CLUSTERS), CLUSTER_ITERS)},
best AS (
  SELECT cluster, string_agg(term, ',' ORDER BY rn) AS terms FROM (
    SELECT cluster, term,
      row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, term) AS rn
    FROM (SELECT cluster, unnest(tokens) AS term FROM final JOIN tokens ON vec_id = doc_id)
    GROUP BY cluster, term)
  WHERE rn <= 10 GROUP BY cluster)
SELECT 'K-Means' AS algorithm, (SELECT round(sum(d), 4) FROM final) AS wsse, cluster AS id,
  size, round(error, 4) AS error, coalesce(terms, '') AS terms
FROM (SELECT cluster, count(*) AS size, sum(d) AS error FROM final GROUP BY cluster)
LEFT JOIN best USING (cluster)"""


LABELLED = f"""{TOKENS},
labelled AS (
  SELECT doc_id, quality * 2 + toxic AS cluster, n_chars / 1000.0e0 AS x, tokens.tokens
  FROM documents JOIN labels USING (doc_id) JOIN tokens USING (doc_id)),
summary AS (
  SELECT cluster, count(*) AS size, sum(pow(x - mean, 2)) AS error
  FROM labelled JOIN (SELECT cluster, avg(x) AS mean FROM labelled GROUP BY cluster)
  USING (cluster) GROUP BY cluster),
terms AS (
  SELECT cluster, string_agg(term, ',' ORDER BY rn) AS terms FROM (
    SELECT cluster, term,
      row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, term) AS rn
    FROM (SELECT cluster, unnest(tokens) AS term FROM labelled) GROUP BY cluster, term)
  WHERE rn <= 10 GROUP BY cluster),
report AS (
  SELECT 'by label' AS algorithm,
    (SELECT round(sum(error), 4) FROM summary) AS wsse, cluster AS id, size,
    round(error, 4) AS error, coalesce(terms, '') AS terms
  FROM summary LEFT JOIN terms USING (cluster))"""

TEXTS = """
texts AS (
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS event_id,
    lower(text) AS text FROM conversations)"""


def _tags_of(source: str) -> str:
    return f"""
tag_lists AS (
  SELECT event_id, [replace(t, '{PREFIX}', '') for t in
    string_split(replace(text, chr(10), ' '), ' ') if starts_with(t, '{PREFIX}')] AS tags
  FROM {source})"""


SAMPLE_TEXTS = f"""{TEXTS},
sample AS (
  SELECT * FROM texts ORDER BY md5(event_id || '-{SEED}'), event_id LIMIT {SAMPLE})"""

STATS = f"""WITH {SAMPLE_TEXTS},{_tags_of('sample')},
best AS (
  SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM tag_lists)
  GROUP BY tag ORDER BY n DESC, tag LIMIT 5)
SELECT CAST(row_number() OVER (ORDER BY n DESC, tag) AS INTEGER) AS rank, tag, n,
  (SELECT count(*) FROM texts) AS texts_seen,
  printf('%.2f', (SELECT round(avg(length(text)), 2) FROM sample)) AS mean_length
FROM best"""

EVENT_TAGS = """
tags AS (
  SELECT event_id, CAST(user_id AS VARCHAR) || '-' || event_type AS tag FROM events)"""

MD5_BITS = f"""
  CAST(CAST('0x' || substr(md5(tag), 1, 8) AS BIGINT) % {BITS} AS INTEGER) AS h1,
  CAST(CAST('0x' || substr(md5(tag), 9, 8) AS BIGINT) % {BITS} AS INTEGER) AS h2"""

_CODES = """flatten([CASE WHEN unicode(c) > 65535
  THEN [(unicode(c) - 65536) // 1024 + 55296, (unicode(c) - 65536) % 1024 + 56320]::BIGINT[]
  ELSE [unicode(c)]::BIGINT[] END for c in string_split(tag, '') if c <> ''])"""
_RAW = f"list_reduce(list_concat([CAST(0 AS BIGINT)], {_CODES}), lambda a, x: (a * 31 + x) % 4294967296)"
LEGACY_BITS = f"""
  CAST(abs(CASE WHEN {_RAW} >= 2147483648 THEN {_RAW} - 4294967296 ELSE {_RAW} END) % {BITS}
    AS INTEGER) AS h1,
  CAST(CAST(list_sum({_CODES}) AS BIGINT) * 67 % {BITS} AS INTEGER) AS h2"""


# Tags of the texts as they come in slices; the space sorts before what ids are made of.
TEXT_TAGS = f"""
slices AS (
  SELECT CAST(floor(conv_id * {BATCHES} / ((SELECT max(conv_id) FROM conversations) + 1)) AS INTEGER)
      || ' ' || conv_id || '-' || turn AS event_id, lower(text) AS text
  FROM conversations),{_tags_of('slices')},
tags AS (
  SELECT event_id || ' ' || lpad(CAST(pos AS VARCHAR), 9, '0') AS event_id, tag FROM (
    SELECT event_id, unnest(range(len(tags))) AS pos, unnest(tags) AS tag FROM tag_lists))"""


def _flags(bits: str, tags: str = EVENT_TAGS) -> str:
    return f"""{tags},
hashed AS (SELECT event_id, tag, {bits} FROM tags),
bit_first AS (
  SELECT bit, min(event_id) AS first FROM (
    SELECT h1 AS bit, event_id FROM hashed UNION ALL SELECT h2, event_id FROM hashed)
  GROUP BY bit),
tag_first AS (SELECT tag, min(event_id) AS first FROM tags GROUP BY tag),
flags AS (
  SELECT h.event_id, h.tag, b1.first < h.event_id AND b2.first < h.event_id AS bloom_seen,
    t.first < h.event_id AS seen
  FROM hashed h JOIN bit_first b1 ON b1.bit = h.h1 JOIN bit_first b2 ON b2.bit = h.h2
  JOIN tag_first t USING (tag))"""


def _audit(bits: str, texts: str = "", tags: str = EVENT_TAGS) -> str:
    return f"""WITH {_flags(bits, tags)},
totals AS (
  SELECT count(*) AS occurrences, count(DISTINCT tag) AS distinct_tags,
    count(*) FILTER (bloom_seen) AS bloom_positive, count(*) FILTER (seen) AS exact_positive,
    count(*) FILTER (bloom_seen AND NOT seen) AS false_positives
  FROM flags)
SELECT *, {texts}distinct_tags - false_positives AS correct,
  round(CAST(false_positives AS DOUBLE) / distinct_tags, 6) AS fp_rate FROM totals"""


SURVEY_STATS = """count(salary) AS n, {low} AS min_value, {high} AS max_value,
  round(avg(salary), 2) AS avg_value"""


def _saturate(value: str) -> str:
    bounded = f"CAST(trunc(least(greatest({value}, -2147483648), 2147483647)) AS INTEGER)"
    return f"CASE WHEN {value} IS NOT NULL THEN {bounded} END"


REPORT = """
SELECT size, row_number() OVER (PARTITION BY size ORDER BY shown) - 1 AS pos, shown
FROM (SELECT size, '(' || replace(items, ',', ', ') || ')' AS shown FROM found)"""

# 82 is the number of buckets of the clustering job.
BUCKETS = f"""{TOKENS},
counts AS (
  SELECT doc_id, CAST(CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 82 AS INTEGER) AS bucket,
    count(*) AS n
  FROM (SELECT doc_id, unnest(tokens) AS term FROM tokens) GROUP BY ALL),
dfs AS (SELECT bucket, count(*) AS df FROM counts GROUP BY bucket)"""

ORACLE: dict[str, str] = {
    "preview": f"WITH {SURVEY} SELECT * FROM survey ORDER BY respondent LIMIT 10",
    "sentinel_filter_keep": f"""WITH {SURVEY} SELECT * FROM survey
      WHERE salary IS NULL OR salary NOT IN ('NA', '0')""",
    "sentinel_filter_drop": f"""WITH {SURVEY} SELECT * FROM survey
      WHERE salary NOT IN ('NA', '0')""",
    "annualise": f"""WITH {SURVEY} SELECT respondent, country,
      TRY_CAST(replace(salary, ',', '') AS DOUBLE) * CASE salary_type
        WHEN 'Monthly' THEN 12 WHEN 'Weekly' THEN 52 ELSE 1 END AS salary FROM survey""",
    "group_stats": f"""WITH {YEARLY} SELECT replace(country, ',', '') AS country,
      {SURVEY_STATS.format(low='min(salary)', high='max(salary)')} FROM yearly GROUP BY 1""",
    "group_stats_saturate": f"""WITH {YEARLY} SELECT replace(country, ',', '') AS country,
      {SURVEY_STATS.format(low=_saturate('min(salary)'), high=_saturate('max(salary)'))}
      FROM yearly GROUP BY 1""",
    "group_count_with_total": f"""WITH {SURVEY}, kept AS (
        SELECT * FROM survey WHERE salary IS NULL OR salary NOT IN ('NA', '0'))
      SELECT 'Total' AS country, count(*) AS n, 0 AS sort_flag FROM kept
      UNION ALL SELECT replace(country, ',', ''), n, 1
      FROM (SELECT country, count(*) AS n FROM kept GROUP BY country)""",
    "align_metrics": f"""WITH {YEARLY},
      m AS (SELECT country, max(salary) AS max_monthly FROM yearly
        WHERE salary_type = 'Monthly' AND salary >= 60000 GROUP BY country),
      w AS (SELECT country, max(salary) AS max_weekly FROM yearly
        WHERE salary_type = 'Weekly' AND salary >= 200000 GROUP BY country),
      y AS (SELECT country, max(salary) AS max_yearly FROM yearly
        WHERE salary_type = 'Yearly' AND salary >= 7000 GROUP BY country)
      SELECT * FROM m FULL JOIN w USING (country) FULL JOIN y USING (country)""",
    "read_survey": f"WITH {SURVEY} SELECT country, salary, salary_type FROM survey",
    "read_ratings": f"""WITH {RATINGS} SELECT CAST("user" AS VARCHAR) AS "user",
      CAST(item AS VARCHAR) AS item, round(rating, 6) AS rating FROM ratings""",
    "read_baskets": f"WITH {EVENT_BASKETS} SELECT item, count(*) AS n FROM rows GROUP BY item",
    "read_documents": """WITH lines AS (
        SELECT text, rtrim(translate(text, chr(10) || chr(13), '  '), ' ') AS body FROM documents)
      SELECT CASE WHEN body = '' AND text <> '' THEN 0 ELSE len(string_split(body, ' ')) END
        AS n_tokens, count(*) AS n FROM lines GROUP BY 1""",
    "write_delimited": f"""WITH {YEARLY}, found AS (
        SELECT replace(country, ',', '') AS country, count(salary) AS n,
          {_saturate('min(salary)')} AS low, {_saturate('max(salary)')} AS high,
          printf('%.2f', round(avg(salary), 2)) AS mean
        FROM yearly GROUP BY 1)
      SELECT concat_ws(',', country, n, low, high, mean) AS line FROM found""",
    "write_counts": f"""WITH {SURVEY}, kept AS (
        SELECT * FROM survey WHERE salary IS NULL OR salary NOT IN ('NA', '0'))
      SELECT 'Total,' || count(*) AS line FROM kept
      UNION ALL SELECT replace(country, ',', '') || ',' || n
      FROM (SELECT country, count(*) AS n FROM kept GROUP BY country)""",
    "write_itemset_report": f"WITH {EVENT_ITEMSETS} SELECT size, shown FROM ({REPORT})",
    "write_cluster_report": f"WITH {LABELLED} SELECT * FROM report",
    "dense_ids": """SELECT value, row_number() OVER (ORDER BY value) - 1 AS id
      FROM (SELECT DISTINCT 'c' || CAST(o_custkey AS VARCHAR) AS value FROM orders)""",
    "item_means": f"""WITH {RATINGS} SELECT item, round(avg(rating), 6) AS mean, count(*) AS n
      FROM ratings GROUP BY item""",
    "user_means": f"""WITH {RATINGS} SELECT "user", round(avg(rating), 6) AS mean, count(*) AS n
      FROM ratings GROUP BY "user" """,
    "item_deviations": f"""WITH {RATINGS}, im AS (
        SELECT item, avg(rating) AS mean FROM ratings GROUP BY item)
      SELECT "user", item, round(rating - mean, 9) + 0.0e0 AS dev
      FROM ratings JOIN im USING (item)""",
    "item_pair_similarity": f"""WITH {PAIRS}
      SELECT * FROM sims""",
    "similar_items": f"""WITH {PAIRS},
      both_ways AS (
        SELECT item_a AS item, item_b AS neighbour, sim, n_common FROM sims
        UNION ALL SELECT item_b, item_a, sim, n_common FROM sims)
      SELECT item, CAST(rank AS INTEGER) AS rank, neighbour, sim, n_common FROM (
        SELECT *, row_number() OVER (PARTITION BY item ORDER BY sim DESC, neighbour) AS rank
        FROM both_ways) WHERE rank <= {NEIGHBOURS}""",
    "item_cf_predict": f"WITH {CF_ABS} SELECT * FROM cf",
    "item_cf_predict_signed": f"WITH {CF_SIGNED} SELECT * FROM cf",
    "rating_error_histogram": f"WITH {CF_ABS}, {_histogram('cf', 'abs(rating - pred_rating)')}",
    "rating_rmse": f"""WITH {CF_ABS} SELECT count(*) AS n,
      round(sqrt(avg(pow(rating - pred_rating, 2))), 6) AS rmse FROM cf""",
    "als_predict": f"""WITH {ALS} SELECT "user", item, round(prediction, 4) + 0.0e0 AS prediction
      FROM als""",
    "als_error_histogram": f"WITH {ALS}, {_histogram('als', 'abs(rating - prediction)')}",
    "als_rmse": f"""WITH {ALS} SELECT count(*) AS n,
      round(sqrt(avg(pow(rating - prediction, 2))), 4) AS rmse FROM als""",
    "neighbour_ratings": f"""WITH {CF_ABS} SELECT "user" || ',' || item || ','
        || printf('%.4f', pred_rating) AS line FROM cf""",
    "factor_ratings": f"""WITH {ALS} SELECT "user" || ',' || item || ','
        || printf('%.4f', round(prediction, 4)) AS line FROM als""",
    "baskets": f"""WITH {EVENT_BASKETS} SELECT basket, string_agg(item, ',' ORDER BY item) AS items
      FROM rows GROUP BY basket""",
    "frequent_itemsets": f"WITH {EVENT_ITEMSETS} SELECT * FROM found",
    "frequent_itemsets_orders": f"WITH {ORDER_ITEMSETS} SELECT * FROM found",
    "son_itemsets": f"WITH {ORDER_ITEMSETS} SELECT * FROM found",
    "son_candidates": f"""WITH {_itemsets(ORDER_BASKETS, ORDER_SHARE, range(1, 5))}
      SELECT count(*) AS frequent, 0::BIGINT AS missed FROM found""",
    "son_verify": f"WITH {EVENT_ITEMSETS} SELECT * FROM found",
    "apriori_level_2": f"WITH {ORDER_ITEMSETS} SELECT * FROM found WHERE size = 2",
    "apriori_level_3": f"WITH {EVENT_ITEMSETS} SELECT * FROM found WHERE size = 3",
    "itemset_report": f"WITH {EVENT_ITEMSETS} {REPORT}",
    "tokenize_docs": f"""WITH {TOKENS} SELECT doc_id, len(tokens) AS n_tokens,
      md5(array_to_string(tokens, '|')) AS tokens_md5 FROM tokens""",
    "term_idf": f"""WITH {TOKENS}, df AS (
        SELECT term, count(*) AS df FROM (
          SELECT unnest(list_distinct(tokens)) AS term FROM tokens) GROUP BY term)
      SELECT term, df, round(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) AS idf
      FROM df""",
    "bucket_tf": f"WITH {BUCKETS} SELECT * FROM counts",
    "bucket_tfidf": f"""WITH {BUCKETS} SELECT doc_id, bucket, n,
      round(n * ln(((SELECT count(*) FROM documents) + 1) / (df + 1)), 6) + 0.0e0 AS weight
      FROM counts JOIN dfs USING (bucket)""",
    "hashed_tf": f"""WITH {TOKENS} SELECT doc_id, CAST(len(tokens) AS DOUBLE) AS total FROM tokens""",
    "partition_profile": f"""WITH {SURVEY}
      SELECT unnest(['standard', 'partition']) AS layout, (SELECT count(*) FROM survey) AS rows""",
    "partition_layout": f"""WITH {SURVEY}
      SELECT CAST(CAST('0x' || substr(md5(coalesce(country, '')), 1, 8) AS BIGINT) % {PARTITIONS} AS INTEGER)
        AS partition, count(*) AS rows FROM survey GROUP BY 1""",
    "kmeans": "SELECT count(*) AS rows, true AS better FROM embeddings",
    "bisecting_kmeans": "SELECT count(*) AS rows, true AS better FROM embeddings",
    "kmeans_seed": f"WITH {SEEDS} SELECT cluster, vec_id FROM seeds",
    "kmeans_assign": f"""WITH {ASSIGNED} SELECT vec_id, cluster, round(d, 6) AS sqdist
      FROM assigned""",
    "kmeans_update": f"""WITH {ASSIGNED},{_update('moved', 'assigned', 'seeds')}
      SELECT cluster, n, CAST(dim AS INTEGER) AS dim, round(value, 6) + 0.0e0 AS value FROM (
        SELECT cluster, n, unnest(range(len(x))) AS dim, unnest(x) AS value FROM moved)""",
    "kmeans_lloyd": f"WITH {_lloyd(SEEDS, ITERS)} SELECT vec_id, cluster, round(d, 6) AS sqdist FROM final",
    "cluster_summary": f"""WITH {ASSIGNED} SELECT cluster, count(*) AS size,
      round(sum(d), 6) AS error FROM assigned GROUP BY cluster""",
    "cluster_terms": f"""WITH {TOKENS} SELECT cluster, CAST(rank AS INTEGER) AS rank, term, n
      FROM (SELECT lang AS cluster, term, count(*) AS n,
          row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, term) AS rank
        FROM (SELECT lang, unnest(tokens) AS term FROM tokens) GROUP BY lang, term)
      WHERE rank <= 10""",
    "cluster_report": f"WITH {LABELLED} SELECT * FROM report",
    "lloyd_report_terms_tf": _terms_report("1"),
    "lloyd_report_terms_tfidf": _terms_report("idf"),
    "extract_tags": f"""WITH {TEXTS},{_tags_of('texts')}
      SELECT event_id, CAST(pos AS INTEGER) AS pos, tag FROM (
        SELECT event_id, unnest(range(len(tags))) AS pos, unnest(tags) AS tag FROM tag_lists)""",
    "tag_counts": f"""WITH {TEXTS},{_tags_of('texts')} SELECT tag, count(*) AS n
      FROM (SELECT unnest(tags) AS tag FROM tag_lists) GROUP BY tag""",
    "reservoir_sample": f"WITH {SAMPLE_TEXTS} SELECT * FROM sample",
    "reservoir_stats": STATS,
    "bloom_hashes": f"WITH {EVENT_TAGS} SELECT DISTINCT tag, {MD5_BITS} FROM tags",
    "bloom_hashes_legacy": f"WITH {EVENT_TAGS} SELECT DISTINCT tag, {LEGACY_BITS} FROM tags",
    "seen_audit": f"WITH {_flags(MD5_BITS)} SELECT event_id, tag, seen FROM flags",
    "bloom_flags": f"WITH {_flags(MD5_BITS)} SELECT event_id, tag, bloom_seen FROM flags",
    "bloom_audit": _audit(MD5_BITS),
    "bloom_audit_legacy": _audit(LEGACY_BITS),
    "stream_reservoir": f"WITH {SAMPLE_TEXTS} SELECT *, {BATCHES} AS batches FROM sample",
    "stream_reservoir_stats": f"SELECT *, {BATCHES} AS batches FROM ({STATS})",
    "stream_bloom": _audit(MD5_BITS, f"occurrences AS texts, {BATCHES} AS batches, "),
    "stream_bloom_timed": _audit(MD5_BITS, f"occurrences AS texts, {TIMED_BATCHES} AS batches, "),
    "stream_bloom_texts": _audit(
        MD5_BITS,
        f"(SELECT count(*) FROM conversations) AS texts, {BATCHES} AS batches, ",
        TEXT_TAGS,
    ),
}
