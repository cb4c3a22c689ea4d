"""The same queries as plain SQL for another engine, written independently."""

from __future__ import annotations

# Table definitions of the derived tables, on the driver's views.
_REVIEW = """
review AS (
  SELECT 'b' || CAST(o_orderkey % 97 AS VARCHAR) AS business_id,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 3 END AS cool,
         o_orderdate AS date,
         o_orderkey % 5 AS funny,
         'r' || CAST(o_orderkey AS VARCHAR) AS review_id,
         CAST(1 + o_orderkey % 5 AS DOUBLE) AS stars,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE documents.text END AS text,
         o_orderkey % 7 AS useful,
         'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(o_orderkey % 8 AS INTEGER) AS spark_partition
  FROM (SELECT *, o_orderkey % (SELECT count(*) FROM documents) AS document_key FROM orders) o
  LEFT JOIN documents ON documents.doc_id = o.document_key
)"""

_ELITE = """
elite AS (
  SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         CAST(year(o_orderdate) AS INTEGER) AS year
  FROM orders
  GROUP BY o_custkey, year(o_orderdate)
  HAVING count(*) >= 2
)"""

_FRIEND = """
friend AS (
  SELECT 'u' || CAST(o_custkey AS VARCHAR) AS user_id,
         'u' || CAST(l_partkey AS VARCHAR) AS friend_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  WHERE o_custkey <> l_partkey
)"""

_USER = """
people AS (
  SELECT c_custkey AS n, 'u' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name
  FROM customer
  UNION ALL
  SELECT s_suppkey AS n, 's' || CAST(s_suppkey AS VARCHAR) AS user_id, s_name AS name
  FROM supplier
),
activity AS (
  SELECT user_id, avg(stars) AS stars, CAST(sum(cool) AS BIGINT) AS cool,
         CAST(sum(funny) AS BIGINT) AS funny, CAST(sum(useful) AS BIGINT) AS useful,
         count(*) AS review_count, min(date) AS first_date
  FROM review GROUP BY user_id
),
users AS (
  SELECT CASE WHEN n % 19 = 0 THEN NULL ELSE stars END AS average_stars,
         CASE WHEN n % 2 = 0 THEN NULL ELSE n % 2 END AS compliment_cool,
         CASE WHEN n % 3 = 0 THEN NULL ELSE n % 3 END AS compliment_cute,
         CASE WHEN n % 4 = 0 THEN NULL ELSE n % 4 END AS compliment_funny,
         CASE WHEN n % 5 = 0 THEN NULL ELSE n % 5 END AS compliment_hot,
         CASE WHEN n % 6 = 0 THEN NULL ELSE n % 6 END AS compliment_list,
         CASE WHEN n % 7 = 0 THEN NULL ELSE n % 7 END AS compliment_more,
         CASE WHEN n % 8 = 0 THEN NULL ELSE n % 8 END AS compliment_note,
         CASE WHEN n % 9 = 0 THEN NULL ELSE n % 9 END AS compliment_photos,
         CASE WHEN n % 10 = 0 THEN NULL ELSE n % 10 END AS compliment_plain,
         CASE WHEN n % 11 = 0 THEN NULL ELSE n % 11 END AS compliment_profile,
         CASE WHEN n % 12 = 0 THEN NULL ELSE n % 12 END AS compliment_writer,
         cool, n % 23 AS fans, funny, name, review_count, useful, people.user_id,
         CASE WHEN n % 17 = 0 THEN NULL ELSE first_date END AS yelping_since
  FROM people LEFT JOIN activity ON people.user_id = activity.user_id
)"""

# Typed forms: NULL numbers as 0, dates without time.
_TYPED_REVIEW = """
typed_review AS (
  SELECT business_id, coalesce(cool, 0) AS cool, CAST(date AS DATE) AS date,
         coalesce(funny, 0) AS funny, review_id, coalesce(stars, 0) AS stars, text,
         coalesce(useful, 0) AS useful, user_id,
         coalesce(spark_partition, 0) AS spark_partition
  FROM review
)"""

_TYPED_USER = """
typed_user AS (
  SELECT coalesce(average_stars, 0) AS average_stars,
         coalesce(compliment_cool, 0) AS compliment_cool,
         coalesce(compliment_cute, 0) AS compliment_cute,
         coalesce(compliment_funny, 0) AS compliment_funny,
         coalesce(compliment_hot, 0) AS compliment_hot,
         coalesce(compliment_list, 0) AS compliment_list,
         coalesce(compliment_more, 0) AS compliment_more,
         coalesce(compliment_note, 0) AS compliment_note,
         coalesce(compliment_photos, 0) AS compliment_photos,
         coalesce(compliment_plain, 0) AS compliment_plain,
         coalesce(compliment_profile, 0) AS compliment_profile,
         coalesce(compliment_writer, 0) AS compliment_writer,
         coalesce(cool, 0) AS cool, coalesce(fans, 0) AS fans, coalesce(funny, 0) AS funny,
         name, coalesce(review_count, 0) AS review_count, coalesce(useful, 0) AS useful,
         user_id, CAST(yelping_since AS DATE) AS yelping_since
  FROM users
)"""

_SHORT_TEXT = """
CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END"""

_YEARS = """
elite_by_user AS (
  SELECT user_id, CAST(sum(n) AS BIGINT) AS elite_years,
         string_agg(CASE WHEN n = 1 THEN CAST(year AS VARCHAR)
                         ELSE CAST(year AS VARCHAR) || '(' || CAST(n AS VARCHAR) || ')' END,
                    ',' ORDER BY year) AS elite_year_list
  FROM (SELECT user_id, year, count(*) AS n FROM elite GROUP BY user_id, year) per_year
  GROUP BY user_id
)"""

_BY_USER = """
links_by_user AS (SELECT user_id, count(*) AS n FROM friend GROUP BY user_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY review_id NULLS LAST) AS place
  FROM typed_review
),
reviews_by_user AS (SELECT user_id, count(*) AS n FROM typed_review GROUP BY user_id)"""

_HOT_FRIEND_NAMES = """
SELECT f.user_id, f.friend_id, u.name
FROM (SELECT user_id,
             CASE WHEN CAST(substr(friend_id, 2) AS BIGINT) % 3 = 0
                  THEN 'u7' ELSE friend_id END AS friend_id
      FROM friend) f
JOIN users u ON u.user_id = f.friend_id"""

_COLUMN_TYPES = {
    "users": [
        ("average_stars", "double"),
        ("compliment_cool", "bigint"),
        ("compliment_cute", "bigint"),
        ("compliment_funny", "bigint"),
        ("compliment_hot", "bigint"),
        ("compliment_list", "bigint"),
        ("compliment_more", "bigint"),
        ("compliment_note", "bigint"),
        ("compliment_photos", "bigint"),
        ("compliment_plain", "bigint"),
        ("compliment_profile", "bigint"),
        ("compliment_writer", "bigint"),
        ("cool", "bigint"),
        ("fans", "bigint"),
        ("funny", "bigint"),
        ("name", "string"),
        ("review_count", "bigint"),
        ("useful", "bigint"),
        ("user_id", "string"),
        ("yelping_since", "timestamp_ntz"),
    ],
    "review": [
        ("business_id", "string"),
        ("cool", "bigint"),
        ("date", "timestamp_ntz"),
        ("funny", "bigint"),
        ("review_id", "string"),
        ("stars", "double"),
        ("text", "string"),
        ("useful", "bigint"),
        ("user_id", "string"),
        ("spark_partition", "int"),
    ],
    "elite": [("user_id", "string"), ("year", "int")],
    "friend": [("user_id", "string"), ("friend_id", "string")],
}
_TABLE_NAMES = {"users": "user", "review": "review", "elite": "elite", "friend": "friend"}


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def _on_user(select: str) -> str:
    return _with(_REVIEW, _USER, _TYPED_USER, select=select)


def _on_review(select: str) -> str:
    return _with(_REVIEW, _TYPED_REVIEW, select=select)


def _on_elite(select: str) -> str:
    return _with(_ELITE, select=select)


def _on_friend(select: str) -> str:
    return _with(_FRIEND, select=select)


def _on_friend_and_user(select: str) -> str:
    return _with(_REVIEW, _USER, _FRIEND, select=select)


def _on_all(select: str) -> str:
    return _with(_REVIEW, _USER, _ELITE, _FRIEND, select=select)


def _profile(where: str = "WHERE u.user_id IS NOT NULL") -> str:
    return _with(
        _REVIEW,
        _USER,
        _ELITE,
        _FRIEND,
        _TYPED_REVIEW,
        _YEARS,
        _BY_USER,
        select=f"""
SELECT u.user_id, u.name, coalesce(c.n, 0) AS reviews_written,
       f.review_id AS first_review_id, f.stars AS first_review_stars,
       coalesce(l.n, 0) AS friend_count, coalesce(e.elite_years, 0) AS elite_years,
       e.elite_year_list
FROM users u
LEFT JOIN reviews_by_user c ON c.user_id = u.user_id
LEFT JOIN ranked f ON f.user_id = u.user_id AND f.place = 1
LEFT JOIN links_by_user l ON l.user_id = u.user_id
LEFT JOIN elite_by_user e ON e.user_id = u.user_id
{where}""",
    )


def _profile_details(where: str = "WHERE u.user_id IS NOT NULL") -> str:
    return _with(
        _REVIEW,
        _USER,
        _ELITE,
        _FRIEND,
        _TYPED_USER,
        _TYPED_REVIEW,
        _YEARS,
        _BY_USER,
        select=f"""
SELECT u.user_id, u.name, u.average_stars, u.review_count, u.fans, u.yelping_since,
       u.cool, u.funny, u.useful, coalesce(c.n, 0) AS reviews_written,
       f.review_id AS first_review_id, f.business_id AS first_review_business_id,
       f.stars AS first_review_stars, f.date AS first_review_date,
       {_SHORT_TEXT.strip()} AS first_review_text, f.useful AS first_review_useful,
       f.funny AS first_review_funny, f.cool AS first_review_cool,
       coalesce(l.n, 0) AS friend_count, coalesce(e.elite_years, 0) AS elite_years,
       e.elite_year_list
FROM typed_user u
LEFT JOIN reviews_by_user c ON c.user_id = u.user_id
LEFT JOIN ranked f ON f.user_id = u.user_id AND f.place = 1
LEFT JOIN links_by_user l ON l.user_id = u.user_id
LEFT JOIN elite_by_user e ON e.user_id = u.user_id
{where}""",
    )


def _column_profile() -> str:
    rows = []
    for view, columns in _COLUMN_TYPES.items():
        for position, (column, data_type) in enumerate(columns, start=1):
            rows.append(
                f"SELECT '{_TABLE_NAMES[view]}' AS table_name, {position} AS position, "
                f"'{column}' AS column_name, '{data_type}' AS data_type, "
                f"count(*) - count({column}) AS null_count, "
                f"CAST(max(length(CAST({column} AS VARCHAR))) AS INTEGER) AS longest_text FROM {view}"
            )
    return _on_all("\nUNION ALL ".join(rows))


def _inventory() -> str:
    return _on_all(
        "\nUNION ALL ".join(
            f"SELECT '{_TABLE_NAMES[view]}' AS table_name, {len(columns)} AS column_count, "
            f"count(*) AS row_count FROM {view}"
            for view, columns in _COLUMN_TYPES.items()
        )
    )


def _first_row(view: str, order_by: str) -> str:
    rows = [
        f"SELECT {position} AS position, '{column}' AS column_name, "
        f"CAST({column} AS VARCHAR) AS value FROM chosen"
        for position, (column, _) in enumerate(_COLUMN_TYPES[view], start=1)
    ]
    chosen = f"chosen AS (SELECT * FROM {view} ORDER BY {order_by} LIMIT 1)"
    return _with(_REVIEW, _USER, _ELITE, _FRIEND, chosen, select="\nUNION ALL ".join(rows))


def oracle_sql() -> dict[str, str]:
    elite_1998 = "SELECT user_id FROM elite WHERE year = 1998"
    return {
        "scan_users": _on_user("SELECT * FROM typed_user"),
        "scan_reviews": _on_review("SELECT * FROM typed_review"),
        "scan_elites": _on_elite("SELECT user_id, year FROM elite"),
        "scan_friends": _on_friend("SELECT user_id, friend_id FROM friend"),
        "limit_users": _on_user("SELECT * FROM typed_user ORDER BY user_id LIMIT 5"),
        "limit_reviews": _on_review("SELECT * FROM typed_review ORDER BY review_id LIMIT 5"),
        "limit_elites": _on_elite("SELECT user_id, year FROM elite ORDER BY user_id, year LIMIT 5"),
        "limit_friends": _on_friend(
            "SELECT user_id, friend_id FROM friend ORDER BY user_id, friend_id LIMIT 5"
        ),
        "user_by_id": _on_user("SELECT * FROM typed_user WHERE user_id = 'u7' LIMIT 1"),
        "review_by_id": _on_review("SELECT * FROM typed_review WHERE review_id = 'r7' LIMIT 1"),
        "reviews_by_user": _on_review("SELECT * FROM typed_review WHERE user_id = 'u7'"),
        "elites_by_user": _on_elite("SELECT user_id, year FROM elite WHERE user_id = 'u7'"),
        "elites_by_year": _on_elite("SELECT user_id, year FROM elite WHERE year = 1998"),
        "friends_by_user": _on_friend("SELECT user_id, friend_id FROM friend WHERE user_id = 'u7'"),
        "users_for_keys": _with(
            _REVIEW,
            _USER,
            _TYPED_USER,
            _ELITE,
            select=f"SELECT * FROM typed_user WHERE user_id IN ({elite_1998})",
        ),
        "reviews_for_keys": _with(
            _REVIEW,
            _TYPED_REVIEW,
            _ELITE,
            select=f"SELECT * FROM typed_review WHERE user_id IN ({elite_1998})",
        ),
        "elites_for_keys": _on_elite(
            f"SELECT user_id, year FROM elite WHERE user_id IN ({elite_1998})"
        ),
        "friends_for_keys": _with(
            _FRIEND,
            _ELITE,
            select=f"SELECT user_id, friend_id FROM friend WHERE user_id IN ({elite_1998})",
        ),
        "count_friends": _on_friend("SELECT count(*) AS count FROM friend WHERE user_id = 'u7'"),
        "count_friends_missing": _on_friend(
            "SELECT count(*) AS count FROM friend WHERE user_id = 'nope'"
        ),
        "count_reviews_of_user": _on_review(
            "SELECT count(*) AS count FROM review WHERE user_id = 'u7'"
        ),
        "friend_counts_all": _on_friend_and_user(
            """
SELECT u.user_id, count(f.user_id) AS friend_count
FROM (SELECT DISTINCT user_id FROM users WHERE user_id IS NOT NULL) u LEFT JOIN friend f ON f.user_id = u.user_id
GROUP BY u.user_id"""
        ),
        "review_counts_all": _on_user(
            """
SELECT u.user_id, u.name, count(r.user_id) AS review_count
FROM users u LEFT JOIN review r ON r.user_id = u.user_id
WHERE u.user_id IS NOT NULL
GROUP BY u.user_id, u.name"""
        ),
        "friends_with_names": _on_friend_and_user(
            """
SELECT f.user_id, f.friend_id, u.name
FROM friend f JOIN users u ON u.user_id = f.friend_id WHERE f.user_id = 'u7'"""
        ),
        "friend_names_all": _on_friend_and_user(
            """
SELECT f.user_id, f.friend_id, u.name
FROM friend f JOIN users u ON u.user_id = f.friend_id"""
        ),
        "hot_friend_names": _on_friend_and_user(_HOT_FRIEND_NAMES),
        "hot_friend_names_plain": _on_friend_and_user(_HOT_FRIEND_NAMES),
        "dangling_friends": _on_friend_and_user(
            """
SELECT f.user_id, f.friend_id FROM friend f
WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = f.friend_id)"""
        ),
        "user_review_count": _on_user(
            """
SELECT u.user_id, u.name, count(r.user_id) AS review_count
FROM users u LEFT JOIN review r ON r.user_id = u.user_id
WHERE u.user_id = 'u7' GROUP BY u.user_id, u.name"""
        ),
        "user_profile": _profile("WHERE u.user_id = 'u7'"),
        "user_profiles_all": _profile(),
        "user_profile_details": _profile_details("WHERE u.user_id = 'u7'"),
        "user_profile_details_all": _profile_details(),
        "first_user_profile": _profile_details(
            "WHERE u.user_id = (SELECT min(user_id) FROM users)"
        ),
        "user_summary": _on_user(
            """
SELECT user_id, name, average_stars, review_count, fans, yelping_since, cool, funny, useful
FROM typed_user"""
        ),
        "review_summary": _on_review(
            f"""
SELECT review_id, user_id, business_id, stars, date, {_SHORT_TEXT.strip()} AS text,
       useful, funny, cool
FROM typed_review"""
        ),
        "table_inventory": _inventory(),
        "profile_columns": _column_profile(),
        "first_row": _first_row("review", "review_id"),
        "first_row_user": _first_row("users", "user_id"),
        "first_row_elite": _first_row("elite", "user_id, year"),
        "first_row_friend": _first_row("friend", "user_id, friend_id"),
    }
