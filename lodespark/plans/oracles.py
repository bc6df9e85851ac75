"""SQL over the same tables that gives the result of each query.

The statements are written for plainness, not speed: pairs are joined in full.
"""

from __future__ import annotations

from lodespark.functions.text import WHITESPACE
from lodespark.operators.clustering import ELBOW
from lodespark.operators.latent import ENSEMBLE_NEIGHBOURS, GRID_WEIGHTS, WEIGHTS as PART_WEIGHTS
from lodespark.operators.neardup import BANDS, MIN_AGREEMENT, ROWS_PER_BAND
from lodespark.operators.recommend import EPS, MIN_OVERLAP, NEIGHBOURS
from lodespark.operators.sampling import IDS_PER_GROUP, MIN_USER_RATINGS
from lodespark.operators.tfidf import MAX_DISTANCE, PLANES
from lodespark.plans.queries import (
    CLUSTERS,
    COEFFICIENTS,
    DIGEST_RANKS,
    NEIGHBOURHOOD_WEIGHTS,
    SAMPLE,
    STEPS,
    SUPPORT,
    TARGET_USER,
)


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(part.strip() for part in parts)


# Graph ----------------------------------------------------------------------------

EDGES = """
edges AS (
  SELECT DISTINCT least(x.l_partkey, y.l_partkey) AS a, greatest(x.l_partkey, y.l_partkey) AS b
  FROM lineitem x JOIN lineitem y
    ON x.l_orderkey = y.l_orderkey AND x.l_linenumber + 1 = y.l_linenumber
  WHERE x.l_partkey <> y.l_partkey)
"""
MUTUAL = """
ends AS (SELECT a AS pivot, b AS node FROM edges UNION ALL SELECT b, a FROM edges),
mutual AS (
  SELECT x.node AS a, y.node AS b, count(*) AS mutual
  FROM ends x JOIN ends y ON x.pivot = y.pivot AND x.node < y.node GROUP BY 1, 2)
"""

# Baskets --------------------------------------------------------------------------

ITEMS = f"""
basket_items AS (
  SELECT DISTINCT conv_id, turn, item FROM (
    SELECT conv_id, turn, unnest(string_split(
             trim(regexp_replace(text, '[{WHITESPACE}]+', ' ', 'g')), ' ')) AS item
    FROM conversations) WHERE item <> ''),
items AS (
  SELECT item, count(*) AS support FROM basket_items GROUP BY 1
  HAVING count(*) >= {SUPPORT})
"""
PAIRS = f"""
kept AS (SELECT b.* FROM basket_items b JOIN items USING (item)),
pairs AS (
  SELECT x.item AS item_a, y.item AS item_b, count(*) AS support
  FROM kept x JOIN kept y ON x.conv_id = y.conv_id AND x.turn = y.turn AND x.item < y.item
  GROUP BY 1, 2 HAVING count(*) >= {SUPPORT})
"""
RULES = """
rules AS (
  SELECT antecedent, consequent, p.support / i.support::DOUBLE AS confidence, p.support
  FROM (SELECT item_a AS antecedent, item_b AS consequent, support FROM pairs
        UNION ALL SELECT item_b, item_a, support FROM pairs) p
  JOIN items i ON i.item = p.antecedent
  WHERE p.support / i.support::DOUBLE >= 0.5)
"""

# Shingles and MinHash -------------------------------------------------------------

SHINGLES = f"""
letters AS (
  SELECT doc_id, string_split(lower(translate(regexp_replace(regexp_replace(
           text, '[{WHITESPACE}]', ' ', 'g'), '[^\\p{{L}} ]', '', 'g'), 'Σ', 'σ')), '') AS c
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, c[i] || c[i + 1] || c[i + 2] AS shingle
  FROM (SELECT doc_id, c, unnest(range(1, len(c) - 1)) AS i FROM letters)),
sets AS (
  SELECT d.doc_id, coalesce(s.joined, '') AS joined, coalesce(s.n, 0) AS n
  FROM documents d LEFT JOIN (
    SELECT doc_id, string_agg(shingle, '|' ORDER BY shingle) AS joined, count(*) AS n
    FROM shingles GROUP BY 1) s USING (doc_id)),
copies AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY joined) AS class_id, n FROM sets),
classes AS MATERIALIZED (
  SELECT class_id AS doc_id, count(*) AS copies, any_value(n) AS n FROM copies GROUP BY 1)
"""
_HASHES = ",\n".join(
    f"    coalesce(min((coalesce(nullif({a} % c, 0), 1) * r + {b} % c) % c), any_value(c))" for a, b in COEFFICIENTS
)
SIGNATURES = f"""
vocabulary AS (
  SELECT shingle, row_number() OVER (ORDER BY shingle) - 1 AS r
  FROM (SELECT DISTINCT shingle FROM shingles)),
total AS (SELECT count(*) AS n FROM vocabulary),
modulus AS (
  SELECT min(x) AS c FROM (
    SELECT unnest(range(greatest(n, 2), greatest(n, 2) + 1000)) AS x FROM total)
  WHERE NOT list_contains(
    list_transform(range(2, floor(sqrt(x))::BIGINT + 1), lambda d: x % d = 0), true)),
signatures AS MATERIALIZED (
  SELECT doc_id, [
{_HASHES}
  ]::BIGINT[] AS sig
  FROM classes CROSS JOIN modulus LEFT JOIN
    (SELECT doc_id, r FROM shingles JOIN vocabulary USING (shingle)) USING (doc_id)
  GROUP BY 1),
bands AS MATERIALIZED (
  SELECT doc_id, band, sig[band * {ROWS_PER_BAND} + 1 : (band + 1) * {ROWS_PER_BAND}] AS bucket
  FROM (SELECT doc_id, sig, unnest(range({BANDS})) AS band FROM signatures))
"""
_CANDIDATES = """
candidates AS (
  SELECT DISTINCT x.doc_id AS a, y.doc_id AS b
  FROM bands x JOIN bands y ON x.band = y.band AND x.bucket = y.bucket AND x.doc_id < y.doc_id),
"""
_JACCARD = """
shared AS (
  SELECT a, b, count(y.shingle) AS n
  FROM agreeing JOIN shingles x ON x.doc_id = a
  LEFT JOIN shingles y ON y.doc_id = b AND y.shingle = x.shingle GROUP BY 1, 2),
duplicates AS (
  SELECT s.a AS doc_a, s.b AS doc_b, x.copies AS copies_a, y.copies AS copies_b,
         s.n / (x.n + y.n - s.n)::DOUBLE AS jaccard
  FROM shared s JOIN classes x ON x.doc_id = s.a JOIN classes y ON y.doc_id = s.b
  UNION ALL SELECT doc_id, doc_id, copies, copies, 1.0 FROM classes WHERE copies > 1)
"""
ALL_CANDIDATES = f"""{_CANDIDATES}
agreeing AS (SELECT a, b FROM candidates),
{_JACCARD}"""
DUPLICATES = f"""{_CANDIDATES}
agreeing AS (
  SELECT a, b FROM (
    SELECT a, b, unnest(x.sig) AS u, unnest(y.sig) AS v
    FROM candidates JOIN signatures x ON x.doc_id = a JOIN signatures y ON y.doc_id = b)
  GROUP BY a, b HAVING avg((u = v)::INT) >= {MIN_AGREEMENT}),
{_JACCARD}"""

# TF-IDF ---------------------------------------------------------------------------

TOKENS = f"""
token_lists AS (
  SELECT doc_id, list_sort(list_filter(string_split(trim(regexp_replace(
           lower(text), '[{WHITESPACE}]+', ' ', 'g')), ' '), lambda t: t <> '')) AS tokens
  FROM documents)
"""
WEIGHTS = """
total AS (SELECT sum(copies)::DOUBLE AS n FROM lists),
counted AS (
  SELECT doc_id, copies, term, count(*) AS tf
  FROM (SELECT doc_id, copies, unnest(tokens) AS term FROM lists) GROUP BY ALL),
weights AS MATERIALIZED (
  SELECT doc_id, copies, term, tf, df, tf * ln(n / df) AS weight
  FROM counted JOIN (SELECT term, sum(copies)::BIGINT AS df FROM counted GROUP BY 1) USING (term)
  CROSS JOIN total)
"""
DOC_LISTS = "lists AS (SELECT doc_id, 1 AS copies, tokens FROM token_lists)"
CLASS_LISTS = """
lists AS (SELECT min(doc_id) AS doc_id, count(*) AS copies, tokens FROM token_lists GROUP BY tokens)
"""
COSINES = f"""
units AS MATERIALIZED (
  SELECT doc_id, copies, term, weight / sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)) AS u
  FROM weights WHERE weight > 0),
cosines AS (
  SELECT x.doc_id AS doc_a, y.doc_id AS doc_b, x.copies AS copies_a, y.copies AS copies_b,
         sum(x.u * y.u) AS similarity
  FROM units x JOIN units y ON x.term = y.term AND x.doc_id < y.doc_id
  GROUP BY 1, 2, 3, 4 HAVING 1 - sum(x.u * y.u) < {MAX_DISTANCE}),
similar_docs AS (
  SELECT * FROM cosines
  UNION ALL SELECT DISTINCT doc_id, doc_id, copies, copies, 1.0 FROM units WHERE copies > 1)
"""
_BITS = "\n    + ".join(
    "(CASE WHEN round(sum(weight * "
    f"(CASE WHEN instr('13579bdf', substr(md5(term), {k + 1}, 1)) > 0 THEN -1 ELSE 1 END)), 6) >= 0"
    f" THEN {1 << k} ELSE 0 END)"
    for k in range(PLANES)
)
BUCKETS = f"""
buckets AS (
  SELECT doc_id, ({_BITS})::BIGINT AS bucket FROM weights GROUP BY 1)
"""


def _normal(plane: int) -> str:
    """Component of a plane: one of the two normal numbers of eight digits of the digest."""
    at = 8 * (plane // 2) + 1
    first, second = (
        f"((('0x' || substr(digest, {place}, 4))::INTEGER + 0.5) / 65536.0)::DOUBLE"
        for place in (at, at + 4)
    )
    turn = ("cos", "sin")[plane % 2]
    return f"sqrt(-2.0 * ln({first})) * {turn}(2.0 * pi() * {second})"


_GAUSSIAN_BITS = "\n    + ".join(
    f"(CASE WHEN round(sum(weight * {_normal(k)}), 6) >= 0 THEN {1 << k} ELSE 0 END)"
    for k in range(PLANES)
)
GAUSSIAN_BUCKETS = f"""
buckets AS (
  SELECT doc_id, ({_GAUSSIAN_BITS})::BIGINT AS bucket
  FROM (SELECT *, md5(term) || md5('1:' || term) AS digest FROM weights) GROUP BY 1)
"""

# k-means --------------------------------------------------------------------------


def _kmeans(ks: tuple[int, ...]) -> str:
    values = ", ".join(f"({k})" for k in ks)
    parts = [
        f"""
points AS MATERIALIZED (
  SELECT vec_id AS id, unnest(range(len(embedding))) AS dim, unnest(embedding)::DOUBLE AS x
  FROM embeddings),
c0 AS (
  SELECT k, rn - 1 AS cl, dim, x AS v
  FROM (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) AS rn FROM embeddings)
  JOIN points USING (id) JOIN (VALUES {values}) t(k) ON rn <= k)"""
    ]
    for n in range(STEPS + 1):
        parts.append(
            f"""
a{n} AS MATERIALIZED (
  SELECT k, id, cl, d FROM (
    SELECT *, row_number() OVER (PARTITION BY k, id ORDER BY d, cl) AS rn FROM (
      SELECT k, id, cl, sum((x - v) * (x - v)) AS d
      FROM points JOIN c{n} USING (dim) GROUP BY 1, 2, 3))
  WHERE rn = 1)"""
        )
        if n < STEPS:
            parts.append(
                f"""
c{n + 1} AS MATERIALIZED (
  SELECT c.k, c.cl, c.dim, coalesce(m.v, c.v) AS v
  FROM c{n} c LEFT JOIN (
    SELECT k, cl, dim, avg(x) AS v FROM a{n} JOIN points USING (id) GROUP BY 1, 2, 3) m
  ON m.k = c.k AND m.cl = c.cl AND m.dim = c.dim)"""
            )
    return _with(*parts)


# Ratings --------------------------------------------------------------------------

RATINGS = """
rated_lines AS (
  SELECT o_custkey AS user_id, l_suppkey AS item_id,
         0.5 * (1 + (l_quantity::BIGINT - 1) % 10)::DOUBLE AS rating,
         epoch(o_orderdate)::BIGINT AS ts, l_orderkey, l_partkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
ratings AS MATERIALIZED (
  SELECT user_id, item_id, rating, ts FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, item_id ORDER BY ts DESC,
      l_orderkey DESC, l_partkey DESC, l_linenumber DESC, rating DESC) AS rn FROM rated_lines)
  WHERE rn = 1),
user_means AS (SELECT user_id, avg(rating) AS mean, count(*) AS count FROM ratings GROUP BY 1),
item_means AS (SELECT item_id, avg(rating) AS mean, count(*) AS count FROM ratings GROUP BY 1),
centered AS MATERIALIZED (
  SELECT r.*, r.rating - m.mean AS centered FROM ratings r JOIN user_means m USING (user_id))
"""
TARGET_REQUESTS = f"""
requests AS (
  SELECT {TARGET_USER}::BIGINT AS user_id, i AS item_id
  FROM (SELECT DISTINCT item_id AS i FROM ratings)
  WHERE i NOT IN (SELECT item_id FROM ratings WHERE user_id = {TARGET_USER}))
"""
_COSINE = (
    f"sum(x.centered * y.centered) / ((sqrt(sum(x.centered * x.centered)) + {EPS})"
    f" * (sqrt(sum(y.centered * y.centered)) + {EPS}))"
)
USER_SIMILARITY = f"""
user_similarity AS MATERIALIZED (
  SELECT x.user_id, y.user_id AS neighbour, count(*) AS overlap, {_COSINE} AS similarity
  FROM centered x JOIN centered y ON x.item_id = y.item_id AND x.user_id <> y.user_id
  WHERE x.user_id IN (SELECT user_id FROM requests)
  GROUP BY 1, 2 HAVING count(*) >= {MIN_OVERLAP})
"""
ITEM_SIMILARITY = f"""
item_similarity AS MATERIALIZED (
  SELECT x.item_id, y.item_id AS neighbour, count(*) AS overlap, {_COSINE} AS similarity
  FROM centered x JOIN centered y ON x.user_id = y.user_id AND x.item_id <> y.item_id
  WHERE x.item_id IN (SELECT item_id FROM requests)
    AND y.item_id IN (SELECT item_id FROM ratings
                      WHERE user_id IN (SELECT user_id FROM requests))
  GROUP BY 1, 2 HAVING count(*) >= {MIN_OVERLAP})
"""


def _predictions(name: str, neighbours: int, rows: str, base: str, key: str) -> str:
    return f"""
{name} AS (
  SELECT q.user_id, q.item_id,
         CASE WHEN p.den > {EPS} THEN coalesce(m.mean, 0) + p.num / p.den
              ELSE coalesce(m.mean, 0) END AS prediction
  FROM (SELECT DISTINCT user_id, item_id FROM requests) q
  LEFT JOIN {base} m ON m.{key} = q.{key}
  LEFT JOIN (
    SELECT user_id, item_id, sum(similarity * residual) AS num, sum(abs(similarity)) AS den
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, item_id
            ORDER BY round(similarity, 10) DESC, neighbour) AS rn FROM ({rows}))
    WHERE rn <= {neighbours} GROUP BY 1, 2) p
  ON p.user_id = q.user_id AND p.item_id = q.item_id)
"""


_USER_ROWS = """
      SELECT DISTINCT q.user_id, q.item_id, s.neighbour, s.similarity, c.centered AS residual
      FROM requests q JOIN user_similarity s ON s.user_id = q.user_id
      JOIN centered c ON c.user_id = s.neighbour AND c.item_id = q.item_id"""
_ITEM_ROWS = """
      SELECT DISTINCT q.user_id, q.item_id, s.neighbour, s.similarity, r.rating - m.mean AS residual
      FROM requests q JOIN item_similarity s ON s.item_id = q.item_id
      JOIN ratings r ON r.user_id = q.user_id AND r.item_id = s.neighbour
      JOIN item_means m ON m.item_id = s.neighbour"""


def _by_user(neighbours: int) -> str:
    return _predictions("by_user", neighbours, _USER_ROWS, "user_means", "user_id")


def _by_item(neighbours: int) -> str:
    return _predictions("by_item", neighbours, _ITEM_ROWS, "item_means", "item_id")


def _top5(source: str) -> str:
    return f"""
SELECT user_id, item_id, round(greatest(0.5, least(5.0, prediction)), 6) AS prediction
FROM {source} ORDER BY prediction DESC, item_id LIMIT 5"""


def _sigmoid(x: str) -> str:
    return f"(1 / (1 + exp(-({x}))))"


POPULARITY = """
popularity AS (
  SELECT item_id, mean, count,
         0.7 * mean + 0.3 * overall + 0.15 * ln(1 + count) AS popularity
  FROM item_means CROSS JOIN (SELECT avg(rating) AS overall FROM ratings))
"""


def _digest(label: str, *columns: str) -> str:
    return f"md5(concat_ws(':', '42', '{label}', {', '.join(columns)}))"


def _number(label: str, column: str) -> str:
    return f"('0x' || substr({_digest(label, column)}, 1, 15))::BIGINT"


def _group(column: str, source: str) -> str:
    """Group in which an id is numbered: a digest modulo the number of groups."""
    groups = f"(SELECT greatest(1, ceil(count(*) / {IDS_PER_GROUP}.0))::BIGINT FROM {source})"
    return f"(('0x' || substr(md5({column}::VARCHAR), 1, 15))::BIGINT % {groups})"


VALIDATION = f"""
eligible AS (SELECT user_id FROM user_means WHERE count >= {MIN_USER_RATINGS}),
positives AS (
  SELECT user_id, item_id, 1 AS label, ts FROM ratings JOIN eligible USING (user_id)
  ORDER BY {_digest('positive', 'user_id', 'item_id')}, user_id, item_id LIMIT {SAMPLE}),
numbered_users AS (
  SELECT user_id, row_number() OVER (ORDER BY {_group('user_id', 'eligible')}, user_id) - 1 AS p
  FROM eligible),
numbered_items AS (
  SELECT item_id, row_number() OVER (ORDER BY {_group('item_id', 'item_means')}, item_id) - 1 AS p
  FROM item_means),
unrated AS (
  SELECT user_id, item_id, row_number() OVER (ORDER BY u.p, i.p) - 1 AS rank
  FROM numbered_users u CROSS JOIN numbered_items i
  WHERE (user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM ratings)),
grid AS (
  SELECT f, h, ceil(f / h)::BIGINT AS w
  FROM (SELECT count(*) AS f, ceil(sqrt(count(*)))::BIGINT AS h FROM unrated)),
round0 AS (
  SELECT d, h, w, (d // w + {_number('round0', 'd % w')}) % h AS y, d % w AS x
  FROM grid, (SELECT unnest(range({SAMPLE} + h * w - f)) AS d FROM grid)),
round1 AS (SELECT d, h, w, y, (x + {_number('round1', 'y')}) % w AS x FROM round0),
round2 AS (SELECT d, h, w, (y + {_number('round2', 'x')}) % h AS y, x FROM round1),
draws AS (SELECT d, y * w + (x + {_number('round3', 'y')}) % w AS rank FROM round2),
negatives AS (
  SELECT user_id, item_id, d FROM draws JOIN unrated USING (rank) ORDER BY d LIMIT {SAMPLE}),
timed AS (
  SELECT user_id, item_id, 0 AS label, ts FROM (
    SELECT n.user_id, n.item_id, r.ts, row_number() OVER (PARTITION BY n.d
      ORDER BY {_digest('time', 'n.d', 'r.item_id')}, r.item_id) AS rn
    FROM negatives n JOIN ratings r ON r.user_id = n.user_id) WHERE rn = 1),
sample AS MATERIALIZED (SELECT * FROM positives UNION ALL SELECT * FROM timed)
"""
COMPONENTS = (
    USER_SIMILARITY,
    ITEM_SIMILARITY,
    _by_user(ENSEMBLE_NEIGHBOURS),
    _by_item(ENSEMBLE_NEIGHBOURS),
    POPULARITY,
    f"""
components AS MATERIALIZED (
  SELECT u.user_id, u.item_id,
         {_sigmoid('(u.prediction - 3.0) / 0.7')} AS user_score,
         {_sigmoid('(i.prediction - 3.0) / 0.7')} AS item_score,
         {_sigmoid('(p.popularity - 3.0) / 0.9')} AS popularity_score
  FROM by_user u JOIN by_item i ON i.user_id = u.user_id AND i.item_id = u.item_id
  JOIN popularity p ON p.item_id = u.item_id)""",
)

# Evaluation -----------------------------------------------------------------------

LENGTHS = """
scored AS (
  SELECT d.n_chars::DOUBLE AS score, l.quality AS label FROM documents d JOIN labels l USING (doc_id))
"""
CURVE = """
steps AS (
  SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY 1),
points AS (
  SELECT score, pos, neg,
         sum(neg) OVER w / (sum(neg) OVER ())::DOUBLE AS fpr,
         sum(pos) OVER w / (sum(pos) OVER ())::DOUBLE AS tpr,
         lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
         row_number() OVER w AS place
  FROM steps WINDOW w AS (ORDER BY score DESC))
"""
_CURVE_START = "SELECT NULL::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr UNION ALL"


def _auc(source: str, by: str) -> str:
    """Rank-sum formula with average ranks."""
    return f"""
SELECT {by}round((sum(CASE WHEN label = 1 THEN r END) - p * (p + 1) / 2) / (p * n), 6) AS auc
FROM (SELECT *, rank() OVER (PARTITION BY {by}0 ORDER BY score)
               + (count(*) OVER (PARTITION BY {by}score) - 1) / 2.0 AS r,
             sum(label) OVER (PARTITION BY {by}0)::DOUBLE AS p,
             sum(1 - label) OVER (PARTITION BY {by}0)::DOUBLE AS n FROM {source})
GROUP BY {by}p, n"""


_CELLS = ", ".join(
    f"({n}, {u}, {i}, {p})" for n, (u, i, p) in enumerate(NEIGHBOURHOOD_WEIGHTS)
)
GRID_SCORES = f"""
grid_scores AS (
  SELECT cell, label, round(greatest(0.0, least(1.0,
           wu * user_score + wi * item_score + wp * popularity_score)), 9) AS score
  FROM sample JOIN components USING (user_id, item_id)
  CROSS JOIN (VALUES {_CELLS}) t(cell, wu, wi, wp))
"""
DIGEST_FACTORS = f"""
factors AS (
  SELECT item_id, n,
    ('0x' || substr(md5(item_id || ':' || n), 1, 8))::BIGINT / 21474836480.0::DOUBLE - 0.1 AS f
  FROM item_means CROSS JOIN (SELECT unnest(range({max(DIGEST_RANKS)})) AS n)),
user_factors AS (
  SELECT user_id, n, sum(f) AS f FROM ratings JOIN factors USING (item_id) GROUP BY 1, 2),
ranked_scores AS MATERIALIZED (
  SELECT s.user_id, s.item_id, rank, {_sigmoid('sum(u.f * i.f)')} AS factor_score
  FROM sample s JOIN user_factors u ON u.user_id = s.user_id
  JOIN factors i ON i.item_id = s.item_id AND i.n = u.n
  JOIN (SELECT unnest([{', '.join(map(str, DIGEST_RANKS))}]) AS rank) ON u.n < rank
  GROUP BY 1, 2, 3)
"""


def _four_parts(weights: tuple[float, ...]) -> str:
    parts = ("user_score", "item_score", "popularity_score", "factor_score")
    total = " + ".join(f"{w} * {p}" for w, p in zip(weights, parts))
    return f"greatest(0.0, least(1.0, {total}))"


_DIGEST_CELLS = " UNION ALL ".join(
    f"SELECT rank, {n} AS cell, label, round({_four_parts(w)}, 9) AS score"
    " FROM sample JOIN components USING (user_id, item_id)"
    " JOIN ranked_scores USING (user_id, item_id)"
    for n, w in enumerate(GRID_WEIGHTS)
)
REQUESTS = "requests AS (SELECT user_id, item_id FROM sample)"
_GRID_WITH = _with(RATINGS, VALIDATION, REQUESTS, *COMPONENTS, GRID_SCORES)

_SAME_BUCKET = """ SELECT doc_a, doc_b, copies_a, copies_b, round(similarity, 6) AS similarity
    FROM similar_docs JOIN buckets x ON x.doc_id = doc_a JOIN buckets y ON y.doc_id = doc_b
    WHERE x.bucket = y.bucket"""

ORACLES: dict[str, str] = {
    "graph_edges": _with(EDGES) + " SELECT a, b FROM edges",
    "mutual_neighbor_counts": _with(EDGES, MUTUAL)
    + """ SELECT node, count(*) AS candidates, sum(mutual)::BIGINT AS mutual FROM (
      SELECT unnest([a, b]) AS node, mutual FROM mutual
      WHERE (a, b) NOT IN (SELECT (a, b) FROM edges)) GROUP BY 1""",
    "friend_recommendations": _with(EDGES, MUTUAL)
    + """ SELECT a, b, mutual FROM mutual WHERE (a, b) NOT IN (SELECT (a, b) FROM edges)
    ORDER BY mutual DESC, a, b LIMIT 10""",
    "frequent_items": _with(ITEMS) + " SELECT item, support FROM items",
    "frequent_pairs": _with(ITEMS, PAIRS) + " SELECT item_a, item_b, support FROM pairs",
    "association_rules": _with(ITEMS, PAIRS, RULES)
    + " SELECT antecedent, consequent, round(confidence, 6) AS confidence, support FROM rules",
    "association_rules_top10": _with(ITEMS, PAIRS, RULES)
    + """ SELECT antecedent, consequent, round(r.confidence, 6) AS confidence, support FROM rules r
    ORDER BY r.confidence DESC, support DESC, antecedent, consequent LIMIT 10""",
    "rule_summary": _with(ITEMS, PAIRS, RULES)
    + """ SELECT (SELECT count(*) FROM items) AS frequent_items,
    (SELECT count(*) FROM rules) AS rules""",
    "text_shingles": _with(SHINGLES)
    + " SELECT doc_id, n AS shingles, md5(joined) AS digest FROM sets",
    "minhash_signatures": _with(SHINGLES, SIGNATURES)
    + """ SELECT c.doc_id, array_to_string(sig, ',') AS signature
    FROM copies c JOIN signatures s ON s.doc_id = c.class_id""",
    "minhash_candidates": _with(SHINGLES, SIGNATURES)
    + """ SELECT band::INTEGER AS band, md5(array_to_string(bucket, ',')) AS bucket, doc_id, classes FROM (
    SELECT *, count(*) OVER (PARTITION BY band, bucket) AS classes FROM bands) WHERE classes > 1""",
    "near_duplicate_copies": _with(SHINGLES) + " SELECT doc_id, class_id FROM copies",
    "near_duplicates": _with(SHINGLES, SIGNATURES, DUPLICATES)
    + """ SELECT doc_a, doc_b, copies_a, copies_b, round(jaccard, 6) AS jaccard
    FROM duplicates""",
    "lsh_amplification": _with(SHINGLES, SIGNATURES, ALL_CANDIDATES)
    + """ SELECT doc_a, doc_b, round(s, 6) AS jaccard,
    round(1 - pow(1 - pow(s, 2), 3), 6) AS and2_or3,
    round(pow(1 - pow(1 - s, 3), 2), 6) AS or3_and2,
    round(pow(1 - pow(1 - pow(s, 2), 2), 2), 6) AS and2_or2_and2,
    round(pow(1 - pow(1 - pow(1 - pow(1 - s, 2), 2), 2), 2), 6) AS or2_and2_or2_and2
    FROM (SELECT doc_a, doc_b, jaccard::DOUBLE AS s FROM duplicates)""",
    "tfidf_weights": _with(TOKENS, DOC_LISTS, WEIGHTS)
    + " SELECT doc_id, term, tf, df, round(weight, 6) AS weight FROM weights",
    "tfidf_copies": _with(TOKENS)
    + " SELECT doc_id, min(doc_id) OVER (PARTITION BY tokens) AS class_id FROM token_lists",
    "tfidf_cosine_exact": _with(TOKENS, CLASS_LISTS, WEIGHTS, COSINES)
    + """ SELECT doc_a, doc_b, copies_a, copies_b, round(similarity, 6) AS similarity
    FROM similar_docs""",
    "tfidf_hyperplane_keys": _with(TOKENS, CLASS_LISTS, WEIGHTS, BUCKETS)
    + " SELECT doc_id, bucket FROM buckets",
    "tfidf_lsh_pairs": _with(TOKENS, CLASS_LISTS, WEIGHTS, COSINES, BUCKETS) + _SAME_BUCKET,
    "tfidf_gaussian_lsh_pairs": _with(TOKENS, CLASS_LISTS, WEIGHTS, COSINES, GAUSSIAN_BUCKETS)
    + _SAME_BUCKET,
    "kmeans_centroids": _kmeans((CLUSTERS,))
    + f" SELECT cl::INTEGER AS cluster_id, dim::INTEGER AS dim, round(v, 6) AS value FROM c{STEPS}",
    "kmeans_assign": _kmeans((CLUSTERS,))
    + f" SELECT id AS point_id, cl::INTEGER AS cluster_id, round(d, 6) AS distance FROM a{STEPS}",
    "kmeans_wcss": _kmeans((CLUSTERS,)) + f" SELECT round(sum(d), 6) AS wcss FROM a{STEPS}",
    "kmeans_elbow": _kmeans(ELBOW)
    + f" SELECT k, round(sum(d), 6) AS wcss FROM a{STEPS} GROUP BY k",
    "cluster_sample": _kmeans((CLUSTERS,))
    + f""" SELECT id AS point_id, cl::INTEGER AS cluster_id, round(x.x, 6) AS x, round(y.x, 6) AS y
    FROM a{STEPS} JOIN points x USING (id) JOIN points y USING (id)
    WHERE x.dim = 1 AND y.dim = 4 AND id IN (
      SELECT vec_id FROM embeddings ORDER BY vec_id LIMIT 5000)""",
    "rating_means": _with(RATINGS)
    + """ SELECT 'user' AS kind, user_id AS id, round(mean, 6) AS mean, count FROM user_means
    UNION ALL SELECT 'item', item_id, round(mean, 6), count FROM item_means""",
    "rating_centered": _with(RATINGS)
    + """ SELECT user_id, item_id, rating, ts, round(centered, 6) AS centered FROM centered""",
    "user_similarity": _with(RATINGS, TARGET_REQUESTS, USER_SIMILARITY)
    + """ SELECT user_id, neighbour, overlap, round(similarity, 6) AS similarity
    FROM user_similarity""",
    "item_similarity": _with(RATINGS, TARGET_REQUESTS, ITEM_SIMILARITY)
    + """ SELECT item_id, neighbour, overlap, round(similarity, 6) AS similarity
    FROM item_similarity""",
    "recommend_user_based": _with(
        RATINGS, TARGET_REQUESTS, USER_SIMILARITY, _by_user(NEIGHBOURS)
    )
    + _top5("by_user"),
    "recommend_item_based": _with(
        RATINGS, TARGET_REQUESTS, ITEM_SIMILARITY, _by_item(NEIGHBOURS)
    )
    + _top5("by_item"),
    "popularity_scores": _with(RATINGS, POPULARITY)
    + f""" SELECT item_id, round(mean, 6) AS mean, count, round(p, 6) AS popularity,
    round({_sigmoid('(p - 3.0) / 0.9')}, 6) AS preference
    FROM (SELECT item_id, mean, count, popularity AS p FROM popularity)""",
    "validation_sample": _with(RATINGS, VALIDATION)
    + " SELECT user_id, item_id, label, ts FROM sample",
    "training_split": _with(RATINGS, VALIDATION)
    + """ SELECT user_id, item_id, rating, ts FROM ratings
    WHERE (user_id, item_id) NOT IN (SELECT (user_id, item_id) FROM positives)""",
    "digest_factor_ensemble": _with(RATINGS, VALIDATION, REQUESTS, *COMPONENTS, DIGEST_FACTORS)
    + f""" SELECT user_id, item_id, round({_four_parts(PART_WEIGHTS)}, 6) AS score, ts
    FROM sample JOIN components USING (user_id, item_id) JOIN ranked_scores USING (user_id, item_id)
    WHERE rank = {max(DIGEST_RANKS)}""",
    "digest_factor_grid": _with(
        RATINGS,
        VALIDATION,
        REQUESTS,
        *COMPONENTS,
        DIGEST_FACTORS,
        f"digest_scores AS ({_DIGEST_CELLS})",
    )
    + _auc("digest_scores", "rank, cell, "),
    "cold_start_scores": _with(RATINGS, VALIDATION, DIGEST_FACTORS)
    + f""" SELECT a.user_id, a.item_id, round(coalesce(d.score, 1.0), 6) AS factor_score FROM (
      SELECT user_id, item_id FROM sample UNION SELECT -1, item_id FROM sample
      UNION SELECT user_id, -1 FROM sample) a
    LEFT JOIN (SELECT s.user_id, s.item_id, {_sigmoid('sum(u.f * i.f)')} AS score
      FROM sample s JOIN user_factors u ON u.user_id = s.user_id
      JOIN factors i ON i.item_id = s.item_id AND i.n = u.n GROUP BY 1, 2) d
    ON a.user_id = d.user_id AND a.item_id = d.item_id""",
    "item_cooccurrence": _with(RATINGS)
    + """ SELECT x.item_id AS item_a, y.item_id AS item_b, count(*) AS support
    FROM ratings x JOIN ratings y ON x.user_id = y.user_id AND x.item_id < y.item_id GROUP BY 1, 2""",
    "ensemble_components": _with(RATINGS, VALIDATION, REQUESTS, *COMPONENTS)
    + """ SELECT user_id, item_id, round(user_score, 6) AS user_score,
    round(item_score, 6) AS item_score, round(popularity_score, 6) AS popularity_score
    FROM components""",
    "roc_auc": _with(LENGTHS) + _auc("scored", ""),
    "roc_curve": _with(LENGTHS, CURVE)
    + f" {_CURVE_START} SELECT score, round(fpr, 6), round(tpr, 6) FROM points",
    "roc_curve_turns": _with(LENGTHS, CURVE)
    + f""" {_CURVE_START} SELECT score, round(fpr, 6), round(tpr, 6) FROM points
    WHERE place = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg""",
    "weight_grid": _GRID_WITH + _auc("grid_scores", "cell, "),
    "weight_grid_best": _GRID_WITH
    + f" SELECT cell, auc FROM ({_auc('grid_scores', 'cell, ')}) ORDER BY auc DESC, cell LIMIT 1",
}
