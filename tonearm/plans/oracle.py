"""DuckDB SQL for the correctness oracle (tables are pre-registered views).

Shared stages are CTE fragments so every oracle query starts from the raw
tables, exactly like its Spark twin.  The k-core oracle unrolls four rounds
(two are needed at the test scales; extra rounds are no-ops).
"""

from __future__ import annotations

from tonearm.plans.fixtures import CFG, MOOD_KEYS, UNKNOWN_SEED, mood_fixture_rows


def clean_sql(x: str) -> str:
    """P2 in DuckDB (RE2 classes; the test data only has ASCII spaces)."""
    return (r"regexp_replace(regexp_replace(regexp_replace(lower(" + x + r"), '^\s+|\s+$', '', 'g'), "
            r"'[^\p{L}\p{N}_\s\-'']', '', 'g'), '\s+', ' ', 'g')")


PLAYS = """plays AS (
  SELECT concat('u', o_custkey) AS user_id,
         CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE concat('mb-', l_partkey) END AS artist_mbid,
         CASE WHEN l_partkey % 97 = 0 AND l_linenumber = 1 THEN NULL
              WHEN l_linenumber % 2 = 0 THEN concat(' ', upper(p_name), ' / No.', l_partkey, '! ')
              ELSE concat(p_name, '  no', l_partkey) END AS artist_name,
         CAST(l_quantity AS BIGINT) AS play_count
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

P1 = "p1 AS (SELECT * FROM plays WHERE artist_name IS NOT NULL)"
DEDUP = """dd AS (SELECT user_id, artist_name, min(artist_mbid) AS artist_mbid,
                  CAST(sum(play_count) AS BIGINT) AS play_count
           FROM p1 WHERE user_id IS NOT NULL GROUP BY user_id, artist_name)"""
CLEAN = f"""cl AS (SELECT user_id, {clean_sql('artist_name')} AS artist_name, artist_mbid, play_count,
                  artist_name AS raw_name FROM dd)"""


def kcore_ctes(src: str = "cl", rounds: int = 4, mu: int = CFG.min_user_interactions,
               ma: int = CFG.min_artist_listeners, out: str = "core") -> list[str]:
    ctes, prev = [], src
    for i in range(1, rounds + 1):
        ctes.append(f"ku{i} AS (SELECT * FROM {prev} WHERE user_id IN "
                    f"(SELECT user_id FROM {prev} GROUP BY user_id HAVING count(*) >= {mu}))")
        ctes.append(f"ka{i} AS (SELECT * FROM ku{i} WHERE artist_name IN "
                    f"(SELECT artist_name FROM ku{i} GROUP BY artist_name HAVING count(*) >= {ma}))")
        prev = f"ka{i}"
    ctes.append(f"{out} AS (SELECT * FROM {prev})")
    return ctes


FEEDBACK = f"fb AS (SELECT *, 1 + {int(CFG.alpha)} * play_count AS confidence, 1 AS preference FROM core)"
SPLIT = f"""fl AS (
  SELECT * EXCLUDE (rn, n), rn <= greatest(1, floor(n * {CFG.test_size})) AS is_test FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
                md5(concat_ws(':', user_id, artist_name, '{CFG.seed}')), play_count,
                artist_mbid NULLS LAST, raw_name NULLS LAST) AS rn,
              count(*) OVER (PARTITION BY user_id) AS n
    FROM fb))"""
TRAIN = "train AS (SELECT * EXCLUDE (is_test) FROM fl WHERE NOT is_test)"
TEST = "test AS (SELECT * EXCLUDE (is_test) FROM fl WHERE is_test)"
ARTISTS = "artists AS (SELECT DISTINCT artist_name FROM core)"
UF = "uf AS (SELECT concat('u', vec_id) AS user_id, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"
IF = f"""itf AS (SELECT {clean_sql("concat(p_name, '  no', p_partkey)")} AS artist_name,
                  CAST(embedding AS DOUBLE[]) AS features
           FROM embeddings JOIN part ON vec_id = p_partkey
           WHERE {clean_sql("concat(p_name, '  no', p_partkey)")} IN (SELECT artist_name FROM artists))"""

STAGES = {
    "plays": [PLAYS], "p1": [PLAYS, P1], "dd": [PLAYS, P1, DEDUP], "cl": [PLAYS, P1, DEDUP, CLEAN],
}
STAGES["core"] = STAGES["cl"] + kcore_ctes()
STAGES["fb"] = STAGES["core"] + [FEEDBACK]
STAGES["fl"] = STAGES["fb"] + [SPLIT]
STAGES["split"] = STAGES["fl"] + [TRAIN, TEST]
STAGES["factors"] = STAGES["split"] + [ARTISTS, UF, IF]


def with_(stage: str, *extra: str) -> str:
    return "WITH " + ",\n".join(STAGES[stage] + list(extra)) + "\n"


def dense_ids_sql() -> list[str]:
    return [
        "umap AS (SELECT user_id, CAST(row_number() OVER (ORDER BY user_id) - 1 AS INTEGER) AS user_idx "
        "FROM (SELECT DISTINCT user_id FROM core))",
        "amap AS (SELECT artist_name, CAST(row_number() OVER (ORDER BY fu, fr, artist_name) - 1 AS INTEGER) "
        "AS artist_idx FROM (SELECT artist_name, min(user_id) AS fu, "
        "arg_min(raw_name, user_id || chr(0) || raw_name) AS fr FROM core GROUP BY artist_name))",
    ]


def unseen_scores_sql(users_cte: str, out: str = "scored") -> str:
    """Exact J5 + J4: every (user, unseen catalog item) score, for the users in ``users_cte``."""
    return f"""{out} AS (
  SELECT u.user_id, i.artist_name, list_dot_product(f.features, i.features) AS score
  FROM {users_cte} u JOIN uf f USING (user_id) CROSS JOIN itf i
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.artist_name = i.artist_name))"""


def topk_sql(src: str, part: str, k: str, out: str, key: str = "artist_name", score: str = "score") -> str:
    return f"""{out} AS (SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY {part} ORDER BY {score} DESC, {key}) AS INTEGER) AS rank
  FROM {src}) WHERE rank <= {k})"""


def mood_fixture_sql() -> str:
    vals = []
    for mood, name, desc, pos, pk, lit in mood_fixture_rows():
        q = lambda s: "NULL" if s is None else "'" + str(s).replace("'", "''") + "'"
        vals.append(f"({q(mood)}, {q(name)}, {q(desc)}, {pos}, {'NULL' if pk is None else pk}, {q(lit)})")
    return (
        "mspec(mood, name, description, pos, partkey, literal) AS (VALUES " + ", ".join(vals) + "),\n"
        "mseeds AS (SELECT mood, name, description, pos, coalesce(literal, concat(p_name, ' no', p_partkey)) AS seed "
        "FROM mspec LEFT JOIN part ON partkey = p_partkey WHERE coalesce(literal, p_name) IS NOT NULL),\n"
        "moods AS (SELECT mood, name, description, list(seed ORDER BY pos) AS seed_artists FROM mseeds "
        "GROUP BY mood, name, description)")


MOOD_ARRAY = "[" + ", ".join(f"'{m}'" for m in MOOD_KEYS) + "]"
UNKNOWN = UNKNOWN_SEED
