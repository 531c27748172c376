"""Operator 4's rounds of further stars."""

from itertools import combinations

from cuegrid.llm import jaccard_join as j


def test_star_rounds_end_when_one_links_nothing(spark, monkeypatch):
    calls, real = [], j._further_stars
    monkeypatch.setattr(j, "_further_stars", lambda *a: calls.append(1) or real(*a))
    shared = " ".join(f"w{i}" for i in range(8))
    docs = [(i, f"{shared} x{i} y{i}") for i in range(60)]  # 8 of 12 words: sketches allow 70 %, the sets don't
    got = j.ngram_jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 1, 70).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(60)} and len(calls) == 1


def test_stars_link_what_the_hub_leaves_out(spark, monkeypatch):
    calls, real = [], j._further_stars
    monkeypatch.setattr(j, "_further_stars", lambda *a: calls.append(1) or real(*a))
    shared = " ".join(f"w{i}" for i in range(14))
    docs = [(0, f"{shared} a b c d e f")] + [(i, f"{shared} m n o p{i} q{i} r{i}") for i in range(1, 70)]
    sets = {i: set(t.split()) for i, t in docs}
    part = {i: i for i in sets}
    for a, b in combinations(sets, 2):
        if 10 * len(sets[a] & sets[b]) >= 7 * len(sets[a] | sets[b]) and part[a] != part[b]:
            lo, hi = sorted((part[a], part[b]))
            part = {k: lo if v == hi else v for k, v in part.items()}
    got = j.ngram_jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 1, 70).collect()
    assert {r.doc_id: r.component_id for r in got} == part and len(set(part.values())) == 2 and calls


def test_differences_decide_pairs_where_they_are_made(spark, monkeypatch):
    """Near copies that don't link go no further than the join that makes their pairs."""
    monkeypatch.setattr(j, "OPEN", 3)
    made, real = [], j._pairs_of_keys
    monkeypatch.setattr(j, "_pairs_of_keys", lambda *a: made.append(real(*a)) or made[0])
    shared = " ".join(f"w{i}" for i in range(8))
    docs = [(i, f"{shared} x{i} y{i}") for i in range(60)]  # 8 of 12 words: sketches allow 70 %, the sets don't
    got = j.ngram_jaccard_join(spark.createDataFrame(docs, "doc_id long, text string"), 1, 70).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i for i in range(60)} and made[0].count() == 0
