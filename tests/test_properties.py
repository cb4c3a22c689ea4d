"""Whole-table operators on random small tables against plain Python."""

from __future__ import annotations

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.helpers import elite, friend, review, rows, tables, user

ids = st.sampled_from(["a", "b", "c", "it's", None])
years = st.sampled_from([2001, 2002, None])

networks = st.fixed_dictionaries(
    {
        "user": st.lists(st.builds(user, ids, st.sampled_from(["Ann", "Bo", None])), max_size=6),
        "review": st.lists(
            st.builds(
                lambda r, u, s: review(r, u, stars=s),
                st.sampled_from(["r1", "r2", "r3"]),
                ids,
                st.sampled_from([1.0, 5.0, None]),
            ),
            max_size=8,
        ),
        "elite": st.lists(st.builds(elite, ids, years), max_size=8),
        "friend": st.lists(st.builds(friend, ids, ids), max_size=12),
    }
)


def smallest(values):
    """Smallest of values that may be None, None first, as Spark orders them."""
    return min(values, key=lambda v: (v is not None, v))


def known_users(network) -> dict:
    """Name kept for each known id."""
    names: dict = {}
    for row in network["user"]:
        if row["user_id"] is not None:
            names.setdefault(row["user_id"], []).append(row["name"])
    return {user_id: smallest(given) for user_id, given in names.items()}


def expected_names(network) -> Counter:
    known = known_users(network)
    return Counter(
        (f["user_id"], f["friend_id"], known[f["friend_id"]])
        for f in network["friend"]
        if f["friend_id"] in known
    )


def expected_dangling(network) -> Counter:
    known = known_users(network)
    return Counter(
        (f["user_id"], f["friend_id"]) for f in network["friend"] if f["friend_id"] not in known
    )


def expected_friend_counts(network) -> Counter:
    links = Counter(f["user_id"] for f in network["friend"])
    return Counter((i, links[i]) for i in known_users(network))


def expected_profiles(network) -> Counter:
    found = Counter()
    for user_id, name in known_users(network).items():
        written = [
            (r["review_id"], r["stars"] or 0.0)
            for r in network["review"]
            if r["user_id"] == user_id
        ]
        first = min(written) if written else (None, None)
        friends = sum(f["user_id"] == user_id for f in network["friend"])
        of_user = Counter(e["year"] or 0 for e in network["elite"] if e["user_id"] == user_id)
        listed = ",".join(f"{y}({n})" if n > 1 else f"{y}" for y, n in sorted(of_user.items()))
        found[
            (user_id, name, len(written), *first, friends, of_user.total(), listed or None)
        ] += 1
    return found


def expected_reviews_of_elite(network) -> Counter:
    elite_ids = {e["user_id"] for e in network["elite"] if e["year"] == 2001} - {None}
    return Counter(
        (r["user_id"], r["review_id"], r["stars"] or 0.0)
        for r in network["review"]
        if r["user_id"] in elite_ids
    )


@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(network=networks)
def test_random_networks(spark, network):
    t = tables(spark, **network)
    assert rows(t.friend_names()) == expected_names(network)
    assert rows(t.dangling_friends()) == expected_dangling(network)
    assert rows(t.friend_counts()) == expected_friend_counts(network)
    assert rows(t.profiles()) == expected_profiles(network)
    found = t.reviews_of_all(t.elites_in(2001).select("user_id"))
    assert rows(found.select("user_id", "review_id", "stars")) == expected_reviews_of_elite(network)
