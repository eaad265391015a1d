"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, as plain SQL over the test tables
(``region nation customer supplier part orders lineitem events ...`` are views).
Every query shares one CTE prefix that defines the stand-in raw tables and the
model layers; DuckDB drops the CTEs a query does not use.
"""

from __future__ import annotations


NULL_KEY = "_dbt_utils_surrogate_key_null_"
DAY1 = "2024-02-01 00:00:00"
DAY2 = "2024-02-02 00:00:00"
LOAD1 = "2024-02-01 06:00:00"
LOAD2 = "2024-02-02 06:00:00"
CUTOFF = "2024-01-20 00:00:00"


def sk(*cols: str) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in cols)
    return f"md5(concat_ws('-', {parts}))"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(pairs: str) -> str:
    return ", ".join("(" + ", ".join(_q(v.strip()) for v in p.split("=")) + ")" for p in pairs.split(";"))


# The lookup for the stand-in catalogue, and the genre lookup of 21 rows.
_SEED = _values(
    "ECONOMY=Economy; LARGE=Large; MEDIUM=Medium; PROMO=Promo; SMALL=Small Type; STANDARD=Standard; blue=Blue; cold=Cold; hot=Hot; "
    "large=Large; new=New; old=Old; red=Red; small=Small; anvil=Anvil; bolt=Bolt; gear=Gear; gizmo=Gizmo; plate=Plate; rod=Rod; "
    "widget=Widget; (no genres listed)=Unknown"
)
_REAL_SEED = _values(
    "Action=Action; Adventure=Adventure; Animation=Animation; Children's=Children; Children=Children; IMAX=IMAX; Comedy=Comedy; "
    "Crime=Crime; Documentary=Documentary; Drama=Drama; Fantasy=Fantasy; Film-Noir=Film Noir; Horror=Horror; Musical=Musical; "
    "Mystery=Mystery; Romance=Romance; Sci-Fi=Science Fiction; Thriller=Thriller; War=War; Western=Western; (no genres listed)=Unknown"
)


def _movie_chain(sfx: str, raw: str, links: str = "stg_links") -> str:
    return f"""
stg_movies{sfx} AS (SELECT movieId AS movie_id, title, genres FROM {raw}),
int_movies_with_links{sfx} AS (
  SELECT m.movie_id, m.title,
         NULLIF(regexp_extract(m.title, '\\(([0-9]{{4}})\\)', 1), '') AS release_year,
         m.genres, l.imdb_id, l.tmdb_id
  FROM stg_movies{sfx} m LEFT JOIN {links} l ON m.movie_id = l.movie_id),
dim_movies{sfx} AS (
  SELECT {sk('movie_id')} AS movie_sk, movie_id, title, release_year, genres, imdb_id, tmdb_id
  FROM int_movies_with_links{sfx})"""


def _incremental(name: str, rows: str, ts: str, keys: list[str], cols: list[str]) -> str:
    """History = rows at/before the cutoff minus every tenth event; batch = rows
    above the history's max ts, latest per key; MERGE = update matched + insert new."""
    on = " AND ".join(f"t.{k} = b.{k}" for k in keys)
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    anynull = " OR ".join(f"{k} IS NULL" for k in keys)
    part = ", ".join(keys)
    upd = ", ".join(
        (f"t.{c}" if c in keys else f"CASE WHEN b.__m THEN b.{c} ELSE t.{c} END AS {c}") for c in cols
    )
    sel = ", ".join(cols)
    return f"""
{name}_hist AS (
  SELECT {sel} FROM {rows}
  WHERE {ts} <= TIMESTAMP '{CUTOFF}' AND event_id % 10 <> 0),
{name}_batch AS (
  SELECT * FROM {rows} WHERE {ts} > (SELECT max({ts}) FROM {name}_hist)),
{name}_latest AS (
  SELECT {sel} FROM (
    SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {ts} DESC, event_id DESC) AS __rn
    FROM {name}_batch WHERE {nn}) WHERE __rn = 1
  UNION ALL SELECT {sel} FROM {name}_batch WHERE {anynull}),
{name} AS (
  SELECT {upd} FROM {name}_hist t LEFT JOIN (SELECT *, TRUE AS __m FROM {name}_latest) b ON {on}
  UNION ALL
  SELECT {sel} FROM {name}_latest b WHERE NOT EXISTS (SELECT 1 FROM {name}_hist t WHERE {on}))"""


PAYLOAD_COLS = ["tmdb_id", "title", "overview", "runtime", "popularity", "budget", "revenue",
                "release_date", "poster_path", "raw_json"]

PREFIX = f"""WITH
raw_movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId,
         p_name || CASE WHEN p_size % 10 = 0 THEN '' ELSE ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
         CASE WHEN p_partkey % 50 = 0 THEN '(no genres listed)'
              ELSE p_type || '| ' || replace(p_name, ' ', '|') END AS genres
  FROM part),
raw_links AS (
  SELECT CAST(c_custkey AS BIGINT) AS movieId, c_name || suffix AS imdbId,
         CAST(CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey + 100000 END AS BIGINT) AS tmdbId
  FROM customer, (VALUES (''), ('-b')) AS twice(suffix) WHERE suffix = '' OR c_custkey % 97 = 0),
raw_ratings AS (
  SELECT event_id, user_id AS userId, CAST(json_extract(props, '$.k') AS BIGINT) AS movieId,
         CAST(least(5.0, 0.5 * ceil(value / 10)) AS DOUBLE) AS rating,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events),
raw_tags AS (
  SELECT event_id, user_id AS userId, CAST(json_extract(props, '$.k') AS BIGINT) AS movieId,
         event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events),
raw_genome_tags AS (SELECT CAST(n_nationkey AS BIGINT) AS tagId, n_name AS tag FROM nation),
raw_genome_scores AS (
  SELECT vec_id AS movieId, CAST(i - 1 AS BIGINT) AS tagId, CASE WHEN (vec_id + i - 1) % 41 = 0 THEN NULL ELSE CAST(embedding[i] AS DOUBLE) END AS relevance
  FROM embeddings, LATERAL (SELECT unnest(generate_series(1, len(embedding))) AS i)),
raw_movies_day2_edit AS (
  SELECT movieId,
         title || CASE WHEN movieId % 5 = 0 THEN '!' ELSE '' END AS title,
         genres || CASE WHEN movieId % 7 = 0 THEN '|Extra' ELSE '' END AS genres
  FROM raw_movies),
raw_movies_day2 AS (
  SELECT * FROM raw_movies_day2_edit WHERE movieId % 11 <> 0
  UNION ALL
  SELECT movieId + 1000000 AS movieId, title, genres FROM raw_movies_day2_edit WHERE movieId % 13 = 0),
raw_responses AS (
  SELECT event_id,
         CAST(CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 500 ELSE 200 END AS BIGINT) AS status,
         '{{"id": ' || CASE WHEN event_id % 40 = 0 THEN 'null' ELSE json_extract_string(props, '$.k') END
           || ', "title": "' || event_type
           || '", "overview": ' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE '"o ' || event_id || '"' END
           || CASE WHEN event_id % 5 = 0 THEN ', "tagline": "none"' ELSE ', "runtime": ' || event_id % 240 END
           || ', "popularity": ' || CAST(value AS VARCHAR) || ', "budget": ' || event_id * 1000
           || ', "revenue": ' || CASE WHEN event_id % 7 = 0 THEN 'null' ELSE CAST(event_id * 1999 AS VARCHAR) END
           || ', "release_date": "' || strftime(ts, '%Y-%m-%d')
           || '", "poster_path": ' || CASE WHEN event_id % 11 = 0 THEN 'null' ELSE '"/p' || event_id || '.jpg"' END
           || '}}' AS body
  FROM events),
genre_mapping AS (SELECT * FROM (VALUES {_SEED}) AS t(raw_genre, display_genre)),
stg_ratings AS (
  SELECT userId AS user_id, movieId AS movie_id, rating,
         make_timestamp("timestamp" * 1000000) AS rating_timestamp
  FROM raw_ratings),
stg_tags AS (
  SELECT userId AS user_id, movieId AS movie_id, tag,
         make_timestamp("timestamp" * 1000000) AS tag_timestamp
  FROM raw_tags),
stg_genome_tags AS (SELECT tagId AS tag_id, tag FROM raw_genome_tags),
stg_genome_scores AS (SELECT movieId AS movie_id, tagId AS tag_id, relevance FROM raw_genome_scores),
stg_links AS (SELECT movieId AS movie_id, imdbId AS imdb_id, tmdbId AS tmdb_id FROM raw_links),
{_movie_chain("", "raw_movies")},
{_movie_chain("_day2", "raw_movies_day2")},
stg_links_once AS (SELECT * FROM stg_links WHERE imdb_id NOT LIKE '%-b'),
{_movie_chain("_once", "raw_movies", "stg_links_once")},
{_movie_chain("_once_day2", "raw_movies_day2", "stg_links_once")},
int_genres_exploded AS (
  SELECT movie_id, trim(piece) AS genre
  FROM (SELECT movie_id, unnest(string_split(genres, '|')) AS piece FROM int_movies_with_links)),
int_ratings_summary AS (
  SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS rating_count,
         min(rating) AS min_rating, max(rating) AS max_rating
  FROM stg_ratings GROUP BY movie_id),
int_movie_top_tags AS (
  SELECT t.movie_id, t.tag_id, g.tag, t.relevance, t.tag_rank
  FROM (SELECT movie_id, tag_id, relevance,
               row_number() OVER (PARTITION BY movie_id ORDER BY relevance DESC NULLS FIRST, tag_id ASC) AS tag_rank
        FROM stg_genome_scores) t
  JOIN stg_genome_tags g ON t.tag_id = g.tag_id
  WHERE t.tag_rank <= 10),
dim_tags AS (SELECT {sk('tag_id')} AS tag_sk, tag_id, tag FROM stg_genome_tags),
fct_ratings AS (
  SELECT {sk('user_id', 'movie_id')} AS rating_sk, user_id, movie_id, rating, rating_timestamp FROM stg_ratings),
fct_tag_applications AS (
  SELECT {sk('user_id', 'movie_id', 'tag')} AS tag_application_sk, user_id, movie_id, tag, tag_timestamp
  FROM stg_tags),
fct_genre_ratings AS (
  SELECT {sk('g.movie_id', 'g.genre')} AS genre_rating_sk, g.movie_id, g.genre, gm.display_genre,
         r.avg_rating, r.rating_count
  FROM int_genres_exploded g
  LEFT JOIN genre_mapping gm ON g.genre = gm.raw_genre
  LEFT JOIN int_ratings_summary r ON g.movie_id = r.movie_id),
rating_rows AS (
  SELECT {sk('userId', 'movieId')} AS rating_sk, userId AS user_id, movieId AS movie_id, rating,
         make_timestamp("timestamp" * 1000000) AS rating_timestamp, event_id
  FROM raw_ratings),
tag_rows AS (
  SELECT {sk('userId', 'movieId', 'tag')} AS tag_application_sk, userId AS user_id, movieId AS movie_id, tag,
         make_timestamp("timestamp" * 1000000) AS tag_timestamp, event_id
  FROM raw_tags),
{_incremental("inc_fct_ratings", "rating_rows", "rating_timestamp", ["user_id", "movie_id"],
              ["rating_sk", "user_id", "movie_id", "rating", "rating_timestamp"])},
{_incremental("inc_fct_tag_applications", "tag_rows", "tag_timestamp", ["user_id", "movie_id", "tag"],
              ["tag_application_sk", "user_id", "movie_id", "tag", "tag_timestamp"])},
payloads AS (
  SELECT event_id,
         CAST(json_extract(body, '$.id') AS BIGINT) AS tmdb_id,
         json_extract_string(body, '$.title') AS title,
         json_extract_string(body, '$.overview') AS overview,
         CAST(json_extract(body, '$.runtime') AS BIGINT) AS runtime,
         CAST(json_extract(body, '$.popularity') AS DOUBLE) AS popularity,
         CAST(json_extract(body, '$.budget') AS BIGINT) AS budget,
         CAST(json_extract(body, '$.revenue') AS BIGINT) AS revenue,
         json_extract_string(body, '$.release_date') AS release_date,
         json_extract_string(body, '$.poster_path') AS poster_path,
         body AS raw_json
  FROM raw_responses WHERE status = 200 AND json_extract_string(body, '$.id') IS NOT NULL),
payload_first AS (
  SELECT {", ".join(PAYLOAD_COLS)}, TIMESTAMP '{LOAD1}' AS loaded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY tmdb_id ORDER BY event_id DESC) AS __rn
    FROM payloads WHERE event_id % 2 = 0 AND tmdb_id IS NOT NULL) WHERE __rn = 1
  UNION ALL
  SELECT {", ".join(PAYLOAD_COLS)}, TIMESTAMP '{LOAD1}' AS loaded_at
  FROM payloads WHERE event_id % 2 = 0 AND tmdb_id IS NULL),
payload_batch AS (
  SELECT {", ".join(PAYLOAD_COLS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY tmdb_id ORDER BY event_id DESC) AS __rn
    FROM payloads WHERE event_id % 2 = 1 AND tmdb_id IS NOT NULL) WHERE __rn = 1
  UNION ALL
  SELECT {", ".join(PAYLOAD_COLS)} FROM payloads WHERE event_id % 2 = 1 AND tmdb_id IS NULL),
payload_after AS (
  SELECT t.tmdb_id,
         {", ".join(f"CASE WHEN b.__m THEN b.{c} ELSE t.{c} END AS {c}" for c in PAYLOAD_COLS[1:])},
         CASE WHEN b.__m THEN TIMESTAMP '{LOAD2}' ELSE t.loaded_at END AS loaded_at
  FROM payload_first t LEFT JOIN (SELECT *, TRUE AS __m FROM payload_batch) b ON t.tmdb_id = b.tmdb_id
  UNION ALL
  SELECT {", ".join(PAYLOAD_COLS)}, TIMESTAMP '{LOAD2}' AS loaded_at
  FROM payload_batch b WHERE NOT EXISTS (SELECT 1 FROM payload_first t WHERE t.tmdb_id = b.tmdb_id))
"""


def _scd2(hist_src: str, new_src: str, key: str, data_cols: list[str], check_cols: list[str]) -> str:
    """Two snapshot runs: all rows of ``hist_src`` current at DAY1, then ``new_src`` at DAY2."""
    cols = ", ".join(data_cols)
    changed = " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in check_cols)
    ch = f"(h.{key} IS NOT NULL AND s.{key} IS NOT NULL AND ({changed}))"
    return f""",
h1 AS (
  SELECT {cols}, md5(CAST({key} AS VARCHAR) || '|' || '{DAY1}') AS scd_id,
         TIMESTAMP '{DAY1}' AS updated_at, TIMESTAMP '{DAY1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
  FROM {hist_src}),
j AS (
  SELECT {", ".join(f"h.{c} AS h_{c}" for c in data_cols)}, h.scd_id AS h_scd_id, h.updated_at AS h_updated_at,
         h.valid_from AS h_valid_from, h.valid_to AS h_valid_to,
         {", ".join(f"s.{c} AS s_{c}" for c in data_cols)},
         h.{key} IS NOT NULL AS in_h, s.{key} IS NOT NULL AS in_s, {ch} AS changed
  FROM h1 h FULL OUTER JOIN {new_src} s ON h.{key} = s.{key})
SELECT {", ".join(f"h_{c} AS {c}" for c in data_cols)}, h_scd_id AS scd_id, h_updated_at AS updated_at,
       h_valid_from AS valid_from, CASE WHEN changed THEN TIMESTAMP '{DAY2}' ELSE h_valid_to END AS valid_to
FROM j WHERE in_h
UNION ALL
SELECT {", ".join(f"s_{c} AS {c}" for c in data_cols)}, md5(CAST(s_{key} AS VARCHAR) || '|' || '{DAY2}') AS scd_id,
       TIMESTAMP '{DAY2}' AS updated_at, TIMESTAMP '{DAY2}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to
FROM j WHERE in_s AND (NOT in_h OR changed)
"""


# The declared checks. Per severity: model, then kind and columns; "nn" not null, "uq" unique,
# "combo" unique combination, "range" 0.5 to 5.0.
_WARN = """
raw_movies: uq movieId; nn movieId title genres
raw_ratings: nn userId movieId rating
raw_tags: nn userId movieId tag
raw_genome_tags: uq tagId; nn tagId tag
raw_genome_scores: nn movieId tagId relevance
raw_links: nn movieId imdbId tmdbId
stg_movies: uq movie_id; nn movie_id title genres
stg_ratings: combo user_id movie_id; nn user_id movie_id rating rating_timestamp; range rating
stg_tags: combo user_id movie_id tag; nn user_id movie_id tag tag_timestamp
stg_genome_tags: uq tag_id; nn tag_id tag
stg_genome_scores: combo movie_id tag_id; nn movie_id tag_id relevance
stg_links: nn movie_id imdb_id tmdb_id
int_movies_with_links: uq movie_id; nn movie_id title
int_genres_exploded: combo movie_id genre; nn movie_id genre
int_ratings_summary: uq movie_id; nn movie_id
int_movie_top_tags: combo movie_id tag_id; nn movie_id tag_id
"""
_ERROR = """
dim_movies: uq movie_sk movie_id; nn movie_sk movie_id title
dim_tags: uq tag_sk tag_id; nn tag_sk tag_id tag
fct_ratings: combo user_id movie_id; uq rating_sk; nn rating_sk user_id movie_id rating rating_timestamp; range rating
fct_tag_applications: combo user_id movie_id tag; uq tag_application_sk; nn tag_application_sk user_id movie_id tag tag_timestamp
fct_genre_ratings: combo movie_id genre; uq genre_rating_sk; nn genre_rating_sk movie_id genre display_genre
"""


def _row(name: str, kind: str, model: str, cols: str, severity: str, count: str) -> str:
    return (
        f"SELECT {_q(name)} AS check_name, {_q(kind)} AS kind, {_q(model)} AS model, {_q(cols)} AS column_name, "
        f"{_q(severity)} AS severity, CAST(({count}) AS BIGINT) AS failures"
    )


def _declared(text: str, severity: str) -> list[tuple[str, str]]:
    """(kind, SQL of the report row) of every declared check."""
    out = []
    for line in text.strip().splitlines():
        model, rest = line.split(": ")
        for rule in rest.split("; "):
            short, *cols = rule.split()
            if short == "combo":
                cs, kind = ", ".join(cols), "unique_combination_of_columns"
                n = f"SELECT count(*) FROM (SELECT {cs} FROM {model} GROUP BY {cs} HAVING count(*) > 1)"
                out.append((kind, _row(f"{kind}__{model}__{'__'.join(cols)}", kind, model, ",".join(cols), severity, n)))
                continue
            for c in cols:
                kind, n = {
                    "nn": ("not_null", f"SELECT count(*) FROM {model} WHERE {c} IS NULL"),
                    "uq": ("unique", f"SELECT count(*) FROM (SELECT {c} FROM {model} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"),
                    "range": ("accepted_range", f"SELECT count(*) FROM {model} WHERE NOT ({c} >= 0.5 AND {c} <= 5.0)"),
                }[short]
                out.append((kind, _row(f"{kind}__{model}__{c}", kind, model, c, severity, n)))
    return out


def _orphans(fact: str) -> str:
    return f"SELECT count(*) FROM {fact} f LEFT JOIN (SELECT DISTINCT movie_id FROM dim_movies) d USING (movie_id) WHERE d.movie_id IS NULL"


_CHECKS = [
    *_declared(_WARN, "warn"),
    *_declared(_ERROR, "error"),
    ("not_null", _row("all_genre_have_display_genre", "not_null", "fct_genre_ratings", "display_genre", "error",
                      "SELECT count(*) FROM fct_genre_ratings WHERE display_genre IS NULL")),
    ("relationships", _row("all_rating_have_movies", "relationships", "fct_ratings", "movie_id", "error", _orphans("fct_ratings"))),
    ("relationships", _row("all_tag_applications_have_movies", "relationships", "fct_tag_applications", "movie_id", "error",
                           _orphans("fct_tag_applications"))),
]


def _report(kinds) -> str:
    body = "\nUNION ALL\n".join(sql for kind, sql in _CHECKS if kinds is None or kind in kinds)
    return (
        ", report AS (\n" + body + "\n)\n"
        "SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status "
        "FROM report"
    )


def _kept_report() -> str:
    line = next(x for x in _ERROR.strip().splitlines() if x.startswith("fct_ratings: "))
    rows = "\nUNION ALL\n".join(sql.replace("FROM fct_ratings", "FROM inc_fct_ratings") for _, sql in _declared(line, "error"))
    return f", report AS (\n{rows}\n)\nSELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM report"


def _metric_cols() -> str:
    return ("avg(rating) AS average_movie_rating, count(rating_sk) AS total_ratings, "
            "count(DISTINCT user_id) AS total_unique_users")


_GRAIN = "\nUNION ALL\n".join(
    f"SELECT '{g}' AS grain, CAST(date_trunc('{g}', rating_timestamp) AS DATE) AS metric_time, {_metric_cols()} "
    f"FROM fct_ratings GROUP BY 1, 2"
    for g in ("day", "week", "month")
)

_BODIES = {
    "stg_movies": "SELECT * FROM stg_movies",
    "stg_links": "SELECT * FROM stg_links",
    "stg_ratings": "SELECT * FROM stg_ratings",
    "stg_tags": "SELECT * FROM stg_tags",
    "stg_genome_tags": "SELECT * FROM stg_genome_tags",
    "stg_genome_scores": "SELECT * FROM stg_genome_scores",
    "seed_lookup": (
        "SELECT g.movie_id, g.genre, gm.display_genre FROM int_genres_exploded g "
        "LEFT JOIN genre_mapping gm ON g.genre = gm.raw_genre"
    ),
    "movies_with_links": "SELECT * FROM int_movies_with_links",
    "release_year": "SELECT movie_id, title, release_year FROM int_movies_with_links",
    "genres_exploded": "SELECT * FROM int_genres_exploded",
    "ratings_summary": "SELECT * FROM int_ratings_summary",
    "top_tags": "SELECT * FROM int_movie_top_tags",
    "dim_movies": "SELECT * FROM dim_movies",
    "dim_tags": "SELECT * FROM dim_tags",
    "surrogate_key": "SELECT * FROM fct_ratings",
    "genre_ratings": "SELECT * FROM fct_genre_ratings",
    "genre_popularity": (
        "SELECT display_genre, round(SUM(avg_rating * rating_count) / SUM(rating_count), 6) AS weighted_avg_rating, "
        "CAST(SUM(rating_count) AS BIGINT) AS total_ratings FROM fct_genre_ratings GROUP BY display_genre "
        "ORDER BY weighted_avg_rating DESC NULLS FIRST, display_genre NULLS FIRST"
    ),
    "top_rated": (
        "SELECT movie_id, d.title, s.avg_rating, s.rating_count FROM int_ratings_summary s "
        "JOIN dim_movies d USING (movie_id) WHERE s.rating_count >= 100 "
        "ORDER BY s.avg_rating DESC NULLS FIRST, movie_id LIMIT 10"
    ),
    "date_spine": (
        ", bounds AS (SELECT min(CAST(rating_timestamp AS DATE)) AS lo, max(CAST(rating_timestamp AS DATE)) AS hi "
        "FROM stg_ratings), "
        "spine AS (SELECT CAST(d AS DATE) AS date_day FROM "
        "(SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM bounds)), "
        "per_day AS (SELECT CAST(rating_timestamp AS DATE) AS date_day, count(rating_sk) AS total_ratings "
        "FROM fct_ratings GROUP BY 1) "
        "SELECT s.date_day, CAST(coalesce(p.total_ratings, 0) AS BIGINT) AS total_ratings "
        "FROM spine s LEFT JOIN per_day p ON s.date_day = p.date_day"
    ),
    "high_water_filter": (
        "SELECT rating_sk, user_id, movie_id, rating, rating_timestamp FROM inc_fct_ratings_batch"
    ),
    "incremental_ratings": "SELECT * FROM inc_fct_ratings",
    "incremental_tags": "SELECT * FROM inc_fct_tag_applications",
    "enrichment_keys_next": (
        "SELECT DISTINCT tmdb_id FROM dim_movies WHERE tmdb_id IS NOT NULL ORDER BY tmdb_id LIMIT 100 OFFSET 100"
    ),
    "seed_csv_lookup": (
        "SELECT g.movie_id, g.genre, gm.display_genre FROM int_genres_exploded g "
        f"LEFT JOIN (VALUES {_REAL_SEED}) AS gm(raw_genre, display_genre) ON g.genre = gm.raw_genre"
    ),
    "stored_incremental_ratings": "SELECT * FROM inc_fct_ratings",
    "fact_checks_kept": _kept_report(),
    "stored_rebuild": "SELECT * FROM dim_movies_day2",
    "stored_seed_lookup": (
        "SELECT g.movie_id, g.genre, gm.display_genre FROM int_genres_exploded g "
        "LEFT JOIN genre_mapping gm ON g.genre = gm.raw_genre"
    ),
    "ratings_summary_kept": (
        "SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS rating_count, min(rating) AS min_rating, max(rating) AS max_rating "
        "FROM inc_fct_ratings GROUP BY movie_id"
    ),
    "orphans_kept": (
        "SELECT movie_id, count(*) AS n FROM inc_fct_ratings f WHERE NOT EXISTS "
        "(SELECT 1 FROM dim_movies_day2 d WHERE d.movie_id = f.movie_id) GROUP BY movie_id"
    ),
    "sql_functions": (
        f", pieces AS (SELECT movie_id, title, trim(unnest(string_split(genres, '|'))) AS genre FROM stg_movies) "
        f"SELECT {sk('movie_id', 'genre')} AS genre_sk, movie_id, "
        "NULLIF(regexp_extract(title, '\\(([0-9]{4})\\)', 1), '') AS release_year, genre FROM pieces"
    ),
    "enrichment_keys": (
        "SELECT DISTINCT tmdb_id FROM dim_movies WHERE tmdb_id IS NOT NULL ORDER BY tmdb_id LIMIT 100"
    ),
    "enrichment_keys_due": (
        ", attempts AS (SELECT CASE WHEN (event_id // 2) % 20 <> 3 THEN event_id // 2 + 100000 END AS tmdb_id, "
        "CAST(CASE event_type WHEN 'error' THEN 404 WHEN 'signup' THEN 500 ELSE 200 END AS BIGINT) AS status, ts FROM events), "
        "last_try AS (SELECT tmdb_id, max({'t': ts, 's': status}) AS m FROM attempts WHERE tmdb_id IS NOT NULL GROUP BY tmdb_id), "
        "ids AS (SELECT DISTINCT tmdb_id FROM dim_movies WHERE tmdb_id IS NOT NULL EXCEPT SELECT tmdb_id FROM attempts WHERE status = 200) "
        "SELECT ids.tmdb_id, l.m.s AS last_status, l.m.t AS last_attempt FROM ids LEFT JOIN last_try l ON ids.tmdb_id = l.tmdb_id "
        "ORDER BY last_attempt NULLS FIRST, ids.tmdb_id LIMIT 400"
    ),
    "payload_parse": "SELECT * FROM payloads",
    "payload_upsert": "SELECT * FROM payload_after",
    "upsert_report": (
        ", rb AS (SELECT status, CASE WHEN status = 200 THEN CAST(json_extract(body, '$.id') AS BIGINT) END AS id "
        "FROM raw_responses WHERE event_id % 2 = 1), "
        "known AS (SELECT DISTINCT tmdb_id FROM payload_first WHERE tmdb_id IS NOT NULL), "
        "j AS (SELECT rb.status, rb.id, k.tmdb_id IS NOT NULL AS is_known FROM rb LEFT JOIN known k ON rb.id = k.tmdb_id) "
        "SELECT CAST(count(*) AS BIGINT) AS keys_queried, "
        "CAST(count(*) FILTER (WHERE status = 200) AS BIGINT) AS movies_fetched, "
        "CAST(count(*) FILTER (WHERE status = 404) AS BIGINT) AS not_found, "
        "CAST(count(*) FILTER (WHERE status NOT IN (200, 404)) AS BIGINT) AS other_errors, "
        "CAST(count(*) FILTER (WHERE status = 200 AND id IS NOT NULL) AS BIGINT) AS movies_loaded, "
        "CAST(count(*) FILTER (WHERE status = 200 AND id IS NULL) AS BIGINT) AS without_id, "
        "CAST(count(DISTINCT CASE WHEN NOT is_known THEN id END) AS BIGINT) AS keys_inserted, "
        "CAST(count(DISTINCT CASE WHEN is_known THEN id END) AS BIGINT) AS keys_updated FROM j"
    ),
    "scd2_raw": _scd2("raw_movies", "raw_movies_day2", "movieId", ["movieId", "title", "genres"], ["genres"]),
    "scd2_stored": _scd2("raw_movies", "raw_movies_day2", "movieId", ["movieId", "title", "genres"], ["genres"]),
    "scd2_dim": _scd2(
        "dim_movies_once", "dim_movies_once_day2", "movie_sk",
        ["movie_sk", "movie_id", "title", "release_year", "genres", "imdb_id", "tmdb_id"],
        ["genres", "release_year", "imdb_id", "tmdb_id"],
    ),
    "metric_average": "SELECT avg(rating) AS average_movie_rating FROM fct_ratings",
    "metric_count": "SELECT count(rating_sk) AS total_ratings FROM fct_ratings",
    "metric_count_distinct": "SELECT count(DISTINCT user_id) AS total_unique_users FROM fct_ratings",
    "metric_by_movie": f"SELECT movie_id, {_metric_cols()} FROM fct_ratings GROUP BY movie_id",
    "metric_by_grain": _GRAIN,
    "check_not_null": _report(("not_null",)),
    "check_unique": _report(("unique",)),
    "check_unique_combo": _report(("unique_combination_of_columns",)),
    "check_range": _report(("accepted_range",)),
    "check_lookup_complete": "SELECT * FROM fct_genre_ratings WHERE display_genre IS NULL",
    "check_orphans": (
        "SELECT f.movie_id FROM fct_ratings f LEFT JOIN dim_movies_day2 d ON f.movie_id = d.movie_id "
        "WHERE d.movie_id IS NULL"
    ),
    "check_orphans_tags": (
        "SELECT f.movie_id FROM fct_tag_applications f LEFT JOIN dim_movies_day2 d ON f.movie_id = d.movie_id "
        "WHERE d.movie_id IS NULL"
    ),
    "check_report": _report(None),
}


def _full(body: str) -> str:
    # Bodies that start with ", name AS (...)" extend the CTE list.
    return PREFIX + ("" if body.startswith(",") else "\n") + body


ORACLE_SQL: dict[str, str] = {k: _full(v) for k, v in _BODIES.items()}
