"""The same results in DuckDB SQL, for every query whose values do not depend on learned factors."""

from __future__ import annotations

from palate.functions.buckets import BUCKETS
from palate.operators.als import RANKS, REG_PARAMS
from palate.plans.queries import DAMPINGS, FLOOR, GENRE, RANK, TOP, USER

RATINGS = """
ratings AS (
  SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(l_partkey AS INTEGER) AS "movieId",
         CAST(CEIL(MAX(l_quantity) / 5) * CAST(0.5 AS DOUBLE) AS FLOAT) AS rating,
         CAST(CAST(date_diff('day', DATE '1970-01-01', CAST(MAX(l_shipdate) AS DATE)) AS BIGINT) * 86400
              AS VARCHAR) AS timestamp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey IS NOT NULL AND l_partkey IS NOT NULL
  GROUP BY o_custkey, l_partkey)"""

MOVIES = """
movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS "movieId", p_name AS title,
         CONCAT(p_type, '|', p_brand) AS genres
  FROM part WHERE p_partkey IS NOT NULL)"""

COUNTS = 'counts AS (SELECT "movieId", COUNT(*) AS "count" FROM ratings GROUP BY "movieId")'
LOW = f'low AS (SELECT "movieId", "count" FROM counts WHERE "count" < {FLOOR})'

POOL = f"""
pool AS (
  SELECT "movieId", title, genres, CAST({USER} AS INTEGER) AS "userId" FROM movies m
  WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = {USER} AND r."movieId" = m."movieId"))"""

POPULAR = """
popular AS (
  SELECT * FROM pool p WHERE NOT EXISTS (SELECT 1 FROM low l WHERE l."movieId" = p."movieId"))"""

def _bucket(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {BUCKETS}"


SPLIT = f"""
numbered AS (
  SELECT *, {_bucket("""CAST("userId" AS VARCHAR) || ':' || CAST("movieId" AS VARCHAR)""")} AS b
  FROM ratings),
parts AS (
  SELECT "userId", "movieId", CAST(rating AS DOUBLE) AS rating,
         CASE WHEN b < 60 THEN 'train' WHEN b < 80 THEN 'validation' ELSE 'test' END AS split
  FROM numbered)"""

WARM = """
warm_test AS (
  SELECT * FROM parts t WHERE split = 'test'
    AND EXISTS (SELECT 1 FROM parts u WHERE u.split = 'train' AND u."userId" = t."userId")
    AND EXISTS (SELECT 1 FROM parts i WHERE i.split = 'train' AND i."movieId" = t."movieId"))"""

FACTORS = "factors AS (SELECT CAST(vec_id AS INTEGER) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"

GRID = f"""
known AS (SELECT "movieId", COUNT(*) AS n, SUM(rating) AS s FROM parts WHERE split = 'train' GROUP BY "movieId"),
mean AS (SELECT SUM(s) / SUM(n) AS mu FROM known),
grid AS (SELECT * FROM (VALUES {", ".join(f"({i}, CAST({k} AS DOUBLE))" for i, k in enumerate(DAMPINGS))})
         AS g(grid_pos, damping)),
errors AS (
  SELECT CAST(grid_pos AS INTEGER) AS grid_pos, damping, COUNT(*) AS n_scored,
         SQRT(AVG(POWER(p.rating - (k.s + damping * mu) / (k.n + damping), 2))) AS error
  FROM parts p JOIN known k ON p."movieId" = k."movieId", mean, grid
  WHERE p.split = 'validation' GROUP BY grid_pos, damping)"""


def _with(*tables: str, select: str) -> str:
    return "WITH " + ",\n".join(t.strip() for t in tables) + "\n" + select


def _list_check(name: str, source: str, where: str = "TRUE") -> str:
    return f"""SELECT '{name}' AS list, LEAST({TOP}, COUNT(*)) AS n_recs, CAST(0 AS BIGINT) AS n_seen,
      CAST(0 AS BIGINT) AS n_under_floor, CAST(0 AS BIGINT) AS n_other_genre, CAST(0 AS BIGINT) AS n_unscored,
      CAST(0 AS BIGINT) AS n_out_of_order, CAST(0 AS BIGINT) AS n_better_left_out
      FROM {source} c WHERE {where} AND EXISTS (SELECT 1 FROM ratings r WHERE r."movieId" = c."movieId")"""


def _one_list(source: str, where: str) -> str:
    return f"""SELECT CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, "movieId", title, ROUND(CAST(p AS DOUBLE), 4) AS score
      FROM (SELECT c."movieId", title, CAST(list_dot_product(u.v, i.v) AS FLOAT) AS p
            FROM {source} c JOIN factors i ON i.id = c."movieId" JOIN factors u ON u.id = {USER} WHERE {where})
      WINDOW w AS (ORDER BY p DESC, "movieId") QUALIFY ROW_NUMBER() OVER w <= {TOP}"""


def _grid(mark: str) -> str:
    """All candidates in order, with the number of warm validation rows, and ``mark`` true for each."""
    candidates = ", ".join(f"({i * len(RANKS) + j}, {reg}, {k})" for i, reg in enumerate(REG_PARAMS) for j, k in enumerate(RANKS))
    return f"""
        SELECT CAST(pos AS INTEGER) AS grid_pos, CAST(reg AS DOUBLE) AS reg_param, CAST(k AS INTEGER) AS rank,
               (SELECT COUNT(*) FROM parts t WHERE split = 'validation'
                AND EXISTS (SELECT 1 FROM parts u WHERE u.split = 'train' AND u."userId" = t."userId")
                AND EXISTS (SELECT 1 FROM parts i WHERE i.split = 'train' AND i."movieId" = t."movieId")) AS n_scored,
               TRUE AS {mark}
        FROM (VALUES {candidates}) AS g(pos, reg, k)"""


IN_GENRE = f"genres LIKE '%{GENRE}%'"

ORACLES = {
    "ratings_scan": _with(RATINGS, select="SELECT * FROM ratings"),
    "csv_ratings_scan": _with(RATINGS, select="SELECT * FROM ratings"),
    "csv_ratings_scan_by_class": _with(RATINGS, select="SELECT * FROM ratings"),
    "csv_to_parquet_ratings": _with(RATINGS, select="SELECT * FROM ratings"),
    "movies_scan": _with(MOVIES, select="SELECT * FROM movies"),
    "csv_malformed_audit": _with(MOVIES, select="""
        SELECT COUNT(*) AS n_lines,
               COUNT(*) FILTER (genres LIKE 'ECONOMY%' OR genres LIKE 'SMALL%') AS n_malformed,
               COUNT(*) FILTER (genres LIKE 'PROMO%') AS n_null_id,
               COUNT(*) FILTER (genres NOT LIKE 'ECONOMY%' AND genres NOT LIKE 'SMALL%'
                                AND genres NOT LIKE 'PROMO%') AS n_kept
        FROM movies"""),
    "csv_convert_audit": _with(MOVIES, """
        kinds AS (SELECT genres LIKE 'ECONOMY%' OR genres LIKE 'SMALL%' AS bad, genres LIKE 'PROMO%' AS no_id FROM movies)""", """
        counts AS (SELECT COUNT(*) AS n_lines, COUNT(*) FILTER (bad) AS n_malformed, COUNT(*) FILTER (no_id) AS n_null_id,
                          COUNT(*) FILTER (NOT bad AND NOT no_id) AS n_kept FROM kinds)""", select="""
        SELECT *, n_kept AS n_written, n_malformed AS n_malformed_lines, n_malformed AS n_line_texts,
               n_null_id AS n_null_id_lines FROM counts"""),
    "csv_rejected_lines": _with(MOVIES, select="""
        SELECT CASE WHEN genres LIKE 'ECONOMY%' THEN concat('x', "movieId", ',', title, ',', genres)
                    WHEN genres LIKE 'SMALL%' THEN concat("movieId", ',', title)
                    ELSE concat(',', title, ',', genres) END AS line,
               CASE WHEN genres LIKE 'PROMO%' THEN 'null id' ELSE 'malformed' END AS reason
        FROM movies WHERE genres LIKE 'ECONOMY%' OR genres LIKE 'SMALL%' OR genres LIKE 'PROMO%'"""),
    "csv_wellformed_items": _with(MOVIES, select="""
        SELECT * FROM movies WHERE genres NOT LIKE 'ECONOMY%' AND genres NOT LIKE 'SMALL%'
          AND genres NOT LIKE 'PROMO%'"""),
    "ratings_head": _with(RATINGS, select='SELECT * FROM ratings ORDER BY "userId", "movieId" LIMIT 5'),
    "items_head": _with(MOVIES, select='SELECT * FROM movies ORDER BY "movieId" LIMIT 5'),
    "low_count_total": _with(RATINGS, COUNTS, LOW, select="SELECT COUNT(*) AS n_items FROM low"),
    "user_watched_count": _with(RATINGS, MOVIES, select=f"""
        SELECT COUNT(*) AS n_items FROM ratings JOIN movies USING ("movieId") WHERE "userId" = {USER}"""),
    "user_unwatched_count": _with(RATINGS, MOVIES, POOL, select="SELECT COUNT(*) AS n_items FROM pool"),
    "dataset_summary": _with(RATINGS, MOVIES, select="""
        SELECT (SELECT COUNT(*) FROM ratings) AS n_ratings,
               (SELECT COUNT(DISTINCT "userId") FROM ratings) AS n_users,
               (SELECT COUNT(DISTINCT "movieId") FROM ratings) AS n_rated_items,
               (SELECT COUNT(*) FROM movies) AS n_items"""),
    "rating_stats": _with(RATINGS, select="""
        SELECT ROUND(AVG(CAST(rating AS DOUBLE)), 6) AS mean_rating,
               ROUND(MIN(CAST(rating AS DOUBLE)), 6) AS min_rating,
               ROUND(MAX(CAST(rating AS DOUBLE)), 6) AS max_rating,
               ROUND(STDDEV_SAMP(CAST(rating AS DOUBLE)), 6) AS stddev_rating
        FROM ratings"""),
    "rating_histogram": _with(RATINGS, select="""
        SELECT rating, COUNT(*) AS "count" FROM ratings GROUP BY rating ORDER BY rating"""),
    "item_rating_counts": _with(RATINGS, COUNTS, select="SELECT * FROM counts"),
    "avg_ratings_per_item": _with(RATINGS, COUNTS, select="""
        SELECT ROUND(AVG("count"), 6) AS avg_ratings FROM counts"""),
    "low_count_items": _with(RATINGS, COUNTS, LOW, select="SELECT * FROM low"),
    "user_watched": _with(RATINGS, MOVIES, select=f"""
        SELECT "movieId", "userId", title, rating FROM ratings JOIN movies USING ("movieId")
        WHERE "userId" = {USER}"""),
    "user_watched_top20": _with(RATINGS, MOVIES, select=f"""
        SELECT "movieId", "userId", title, rating FROM ratings JOIN movies USING ("movieId")
        WHERE "userId" = {USER} ORDER BY rating DESC, "movieId" LIMIT 20"""),
    "user_unwatched": _with(RATINGS, MOVIES, POOL, select="SELECT * FROM pool"),
    "user_unwatched_head": _with(RATINGS, MOVIES, POOL, select='SELECT * FROM pool ORDER BY "movieId" LIMIT 20'),
    "all_users_unwatched_counts": _with(RATINGS, MOVIES, select="""
        SELECT "userId", (SELECT COUNT(*) FROM movies) - COUNT(DISTINCT m."movieId") AS n_unwatched
        FROM ratings LEFT JOIN movies m USING ("movieId") GROUP BY "userId\""""),
    "popular_unwatched": _with(RATINGS, MOVIES, COUNTS, LOW, POOL, POPULAR, select="SELECT * FROM popular"),
    "genre_filter": _with(MOVIES, select=f"SELECT * FROM movies WHERE {IN_GENRE}"),
    "genre_substring": _with(MOVIES, select="SELECT * FROM movies WHERE genres LIKE '%Brand#1%'"),
    "genre_token": _with(MOVIES, select="""
        SELECT * FROM movies WHERE list_contains(string_split(genres, '|'), 'Brand#1')"""),
    "orphan_ratings": _with(RATINGS, MOVIES, select="""
        SELECT COUNT(*) AS n_orphans FROM ratings r
        WHERE NOT EXISTS (SELECT 1 FROM movies m WHERE m."movieId" = r."movieId")"""),
    "dropna_any": _with(RATINGS, MOVIES, select=f"""
        SELECT m."movieId", title, genres, rating FROM movies m
        LEFT JOIN (SELECT "movieId", rating FROM ratings WHERE "userId" = {USER}) r ON r."movieId" = m."movieId"
        WHERE m."movieId" IS NOT NULL AND title IS NOT NULL AND genres IS NOT NULL AND rating IS NOT NULL"""),
    "dense_user_index": """
        SELECT o_custkey, CAST(ROW_NUMBER() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS "index"
        FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)""",
    "dense_purchases": """
        SELECT o_orderkey, CAST(DENSE_RANK() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS o_custkey
        FROM orders WHERE o_custkey IS NOT NULL""",
    "random_split_check": _with(RATINGS, select="""
        SELECT COUNT(*) AS n_pairs, CAST(1 AS BIGINT) AS max_parts_per_pair FROM ratings"""),
    "hash_split_counts": _with(RATINGS, SPLIT, select="""
        SELECT split, COUNT(*) AS n_rows FROM parts GROUP BY split"""),
    "item_mean_rmse": _with(RATINGS, SPLIT, select="""
        SELECT COUNT(*) AS n_scored, ROUND(SQRT(AVG(POWER(t.rating - k.guess, 2))), 6) AS rmse
        FROM parts t JOIN (SELECT "movieId", AVG(rating) AS guess FROM parts WHERE split = 'train'
                           GROUP BY "movieId") k USING ("movieId")
        WHERE t.split = 'test'"""),
    "item_mean_predictions": _with(RATINGS, SPLIT, select="""
        SELECT "userId", "movieId", ROUND(k.guess, 6) AS prediction
        FROM parts t LEFT JOIN (SELECT "movieId", AVG(rating) AS guess FROM parts WHERE split = 'train'
                                GROUP BY "movieId") k USING ("movieId")
        WHERE t.split = 'test'"""),
    "grid_metrics": _with(RATINGS, SPLIT, GRID, select="SELECT grid_pos, damping, n_scored, ROUND(error, 6) AS rmse FROM errors"),
    "grid_argmin": _with(RATINGS, SPLIT, GRID, select="""
        SELECT grid_pos, damping, n_scored, ROUND(error, 6) AS rmse FROM errors ORDER BY error, grid_pos LIMIT 1"""),
    "factor_scores": _with(RATINGS, FACTORS, select="""
        SELECT "userId", "movieId",
               ROUND(CAST(CAST(list_dot_product(u.v, i.v) AS FLOAT) AS DOUBLE), 4) AS score
        FROM ratings LEFT JOIN factors u ON u.id = "userId" LEFT JOIN factors i ON i.id = "movieId\""""),
    "factor_score_counts": _with(RATINGS, FACTORS, select="""
        SELECT COUNT(*) FILTER (u.id IS NOT NULL AND i.id IS NOT NULL) AS n_scored,
               COUNT(*) FILTER (u.id IS NULL OR i.id IS NULL) AS n_unscored
        FROM ratings LEFT JOIN factors u ON u.id = "userId" LEFT JOIN factors i ON i.id = "movieId\""""),
    **{f"topn_one_user{name}": _with(RATINGS, MOVIES, COUNTS, LOW, POOL, POPULAR, FACTORS, select=_one_list(source, where))
       for name, source, where in (("", "pool", "TRUE"), ("_genre", "pool", IN_GENRE), ("_popular", "popular", "TRUE"),
                                   ("_popular_genre", "popular", IN_GENRE))},
    "ranked_scores": _with(RATINGS, FACTORS, select=f"""
        SELECT "userId", CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, "movieId" FROM (
          SELECT "userId", "movieId", CAST(list_dot_product(u.v, i.v) AS FLOAT) AS p
          FROM ratings JOIN factors u ON u.id = "userId" JOIN factors i ON i.id = "movieId")
        WINDOW w AS (PARTITION BY "userId" ORDER BY p DESC, "movieId") QUALIFY ROW_NUMBER() OVER w <= {TOP}"""),
    "topn_per_user": _with(RATINGS, FACTORS, select=f"""
        SELECT "userId", CAST(ROW_NUMBER() OVER w AS INTEGER) AS rank, "movieId",
               ROUND(CAST(p AS DOUBLE), 4) AS score
        FROM (SELECT u.id AS "userId", i.id AS "movieId", CAST(list_dot_product(u.v, i.v) AS FLOAT) AS p
              FROM factors u, factors i
              WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r."userId" = u.id AND r."movieId" = i.id))
        WINDOW w AS (PARTITION BY "userId" ORDER BY p DESC, "movieId") QUALIFY ROW_NUMBER() OVER w <= {TOP}"""),
    "als_prediction_counts": _with(RATINGS, SPLIT, WARM, select="""
        SELECT (SELECT COUNT(*) FROM warm_test) AS n_scored,
               (SELECT COUNT(*) FROM parts WHERE split = 'test') - (SELECT COUNT(*) FROM warm_test) AS n_cold"""),
    "als_cold_start_audit": _with(RATINGS, f"""
        trained AS (SELECT * FROM ratings
          WHERE {_bucket("""'userId:' || CAST("userId" AS VARCHAR)""")} < {BUCKETS - 2}
            AND {_bucket("""'movieId:' || CAST("movieId" AS VARCHAR)""")} < {BUCKETS - 2})""", """
        marked AS (SELECT EXISTS (SELECT 1 FROM trained t WHERE t."userId" = r."userId") AS warm_user,
                          EXISTS (SELECT 1 FROM trained t WHERE t."movieId" = r."movieId") AS warm_item
                   FROM ratings r)""", select="""
        SELECT warm_user, warm_item, COUNT(*) AS n_rows,
               COUNT(*) FILTER (NOT (warm_user AND warm_item)) AS n_nan, CAST(0 AS BIGINT) AS n_null
        FROM marked GROUP BY warm_user, warm_item"""),
    **{name: _with(RATINGS, SPLIT, select=_grid(mark)) for name, mark in (("als_grid_shape", "mark_is_right"), ("als_grid_checks", "agrees"))},
    "als_fit_residuals": _with(RATINGS, select="""
        SELECT COUNT(DISTINCT "userId") AS n_users, CAST(0 AS BIGINT) AS n_over FROM ratings"""),
    "als_rmse_checks": _with(RATINGS, SPLIT, select=" UNION ALL ".join(f"""
        SELECT '{mode}' AS mode, COUNT(*) AS n_scored, TRUE AS as_evaluator, TRUE AS as_factor_product
        FROM parts t WHERE split = 'test'
          AND EXISTS (SELECT 1 FROM parts u WHERE {seen.replace('x.', 'u.')} AND u."userId" = t."userId")
          AND EXISTS (SELECT 1 FROM parts i WHERE {seen.replace('x.', 'i.')} AND i."movieId" = t."movieId")"""
        for mode, seen in (("train", "x.split = 'train'"), ("train+validation", "x.split <> 'test'"), ("all ratings", "TRUE")))),
    "als_topn_user_checks": _with(RATINGS, MOVIES, COUNTS, LOW, POOL, POPULAR, select="\nUNION ALL\n".join([
        _list_check("all", "pool"), _list_check("genre", "pool", IN_GENRE),
        _list_check("popular", "popular"), _list_check("popular_genre", "popular", IN_GENRE)])),
    "als_topn_all_users_counts": _with(RATINGS, select=f"""
        SELECT "userId", LEAST({TOP}, (SELECT COUNT(DISTINCT "movieId") FROM ratings) - COUNT(*)) AS n_recs
        FROM ratings GROUP BY "userId"
        HAVING (SELECT COUNT(DISTINCT "movieId") FROM ratings) > COUNT(*)"""),
    "als_topn_all_users_checks": _with(RATINGS, f"""
        lists AS (
          SELECT LEAST({TOP}, (SELECT COUNT(DISTINCT "movieId") FROM ratings) - COUNT(*)) AS n
          FROM ratings GROUP BY "userId")""", select="""
        SELECT COUNT(*) FILTER (n > 0) AS n_lists, CAST(SUM(n) AS BIGINT) AS n_entries,
               CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_unscored,
               CAST(0 AS BIGINT) AS n_out_of_order, CAST(0 AS BIGINT) AS n_gaps,
               CAST(0 AS BIGINT) AS n_better_left_out
        FROM lists"""),
    "als_topn_all_users_popular_genre_counts": _with(RATINGS, MOVIES, COUNTS, f"""
        allowed AS (
          SELECT "movieId" FROM movies JOIN counts USING ("movieId") WHERE {IN_GENRE} AND "count" >= {FLOOR})""",
        select=f"""
        SELECT "userId", LEAST({TOP}, (SELECT COUNT(*) FROM allowed) - COUNT(a."movieId")) AS n_recs
        FROM ratings LEFT JOIN allowed a USING ("movieId") GROUP BY "userId"
        HAVING (SELECT COUNT(*) FROM allowed) > COUNT(a."movieId")"""),
    "als_topn_overfetch_checks": _with(RATINGS, f"""
        lists AS (
          SELECT LEAST({TOP}, (SELECT COUNT(DISTINCT "movieId") FROM ratings) - COUNT(*)) AS n
          FROM ratings GROUP BY "userId")""", select="""
        SELECT CAST(SUM(n) AS BIGINT) AS n_entries, CAST(0 AS BIGINT) AS n_in_one_only, CAST(0 AS BIGINT) AS n_other_score FROM lists"""),
    "als_topn_all_users_popular_genre_checks": _with(RATINGS, MOVIES, COUNTS, f"""
        allowed AS (
          SELECT "movieId" FROM movies JOIN counts USING ("movieId") WHERE {IN_GENRE} AND "count" >= {FLOOR})""", f"""
        lists AS (
          SELECT LEAST({TOP}, (SELECT COUNT(*) FROM allowed) - COUNT(a."movieId")) AS n
          FROM ratings LEFT JOIN allowed a USING ("movieId") GROUP BY "userId")""", select="""
        SELECT COUNT(*) FILTER (n > 0) AS n_lists, COALESCE(CAST(SUM(n) AS BIGINT), 0) AS n_entries, CAST(0 AS BIGINT) AS n_seen,
               CAST(0 AS BIGINT) AS n_not_allowed, CAST(0 AS BIGINT) AS n_other_score, CAST(0 AS BIGINT) AS n_out_of_order,
               CAST(0 AS BIGINT) AS n_better_left_out
        FROM lists"""),
    "als_factor_counts": _with(RATINGS, select=f"""
        SELECT 'user' AS side, COUNT(DISTINCT "userId") AS n_ids, CAST({RANK} AS INTEGER) AS min_rank,
               CAST({RANK} AS INTEGER) AS max_rank FROM ratings
        UNION ALL
        SELECT 'item', COUNT(DISTINCT "movieId"), CAST({RANK} AS INTEGER), CAST({RANK} AS INTEGER) FROM ratings"""),
    "als_save_load_roundtrip": _with(RATINGS, SPLIT, WARM, select="""
        SELECT COUNT(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM warm_test"""),
}
