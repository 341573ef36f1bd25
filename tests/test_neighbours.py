"""Neighbours by gap keys and pieces against plain comparison of every pair."""

import random

import pytest
from pyspark.sql import functions as F

from mailtriage.operators import lookalike as LA, neighbours as N


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(seed, n, letters="abc", longest=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest))) for _ in range(n)]


def listed(frame, names):
    return frame("domain string", *[(w,) for w in names])


def nearest(asked, sites):
    return {a: min(((edits(a, s), s) for s in set(sites)), default=(99, "")) for a in set(asked)}


@pytest.mark.parametrize("letters, longest", [("ab", 6), ("abcd", 8), ("é日.-", 5)])
def test_nearest_within_two_equals_all_pairs(frame, letters, longest):
    asked, sites = words(1, 60, letters, longest), words(2, 25, letters, longest)
    got = {r["domain"]: (r["distance"], r["closest"]) for r in LA.look_alikes(listed(frame, asked), listed(frame, sites)).collect()}
    assert got == {a: best for a, best in nearest(asked, sites).items() if 1 <= best[0] <= 2}


@pytest.mark.parametrize("few, bounds", [(200, (3, 4)), (0, (3, 4)), (0, (5,)), (0, ())])
def test_nearest_sites_by_every_way(frame, monkeypatch, few, bounds):
    monkeypatch.setattr(LA, "FEW_SITES", few)
    monkeypatch.setattr(LA, "PIECE_BOUNDS", bounds)
    monkeypatch.setattr(LA, "BLOCK_SITES", 7)
    rng = random.Random(3)
    names = ["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 14))) + rng.choice([".com", ".co.uk", ".x", ""]) for _ in range(90)]
    asked, sites = names[:60] + ["", "a"], names[50:]
    got = {r["domain"]: (r["distance"], r["closest"]) for r in LA.nearest_sites(listed(frame, asked), listed(frame, sites)).collect()}
    assert got == nearest(asked, sites)


def test_far_sites_can_be_left_out(frame):
    got = LA.nearest_sites(listed(frame, ["paypa1.com", "zzzzzzzzzzzzzzzz.org"]), listed(frame, ["paypal.com"]), far=False)
    assert {tuple(r) for r in got.collect()} == {("paypa1.com", 1, "paypal.com"), ("zzzzzzzzzzzzzzzz.org", 99, "")}


def test_null_domains_and_sites(frame):
    got = LA.nearest_sites(listed(frame, [None, "a.com"]), listed(frame, [None, "a.com", "a.com"]))
    assert {tuple(r) for r in got.collect()} == {(None, 99, ""), ("a.com", 0, "a.com")}
    assert LA.look_alikes(listed(frame, [None, "b.com"]), listed(frame, [None])).collect() == []
    assert LA.look_alike_groups(listed(frame, [None])).collect() == []


def families(names):
    first = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a in first:
            for b in first:
                if first[b] < first[a] and edits(a, b) <= 2:
                    first[a], changed = first[b], True
    return first


@pytest.mark.parametrize("letters, longest, n", [("ab", 9, 40), ("abcdefgh", 8, 60), ("0123.", 7, 50)])
def test_groups_are_the_families_of_all_pairs(frame, letters, longest, n):
    names = words(7, n, letters, longest)
    got = {r["domain"]: r["representative"] for r in LA.look_alike_groups(listed(frame, names + names[:3])).collect()}
    assert got == families(set(names))


def test_numbered_hosts_give_rows_in_proportion_to_hosts(spark):
    hosts = spark.range(20_000).select(F.format_string("host%05d.net", "id").alias("domain"))
    rows = N._key_rows(hosts, "domain", "domain")
    assert rows.count() <= 20_000 * 400  # keys of one name of 13 letters, however many names share them
    grouped = LA.look_alike_groups(hosts)
    assert grouped.count() == 20_000
    assert [r[0] for r in grouped.select("representative").distinct().collect()] == ["host00000.net"]


def test_pieces_measure_few_pairs(spark):
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789-"
    sites = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(6, 18))) + rng.choice([".com", ".com", ".net", ".co.uk"])
                    for _ in range(10_000)})
    typo = []
    for site in sites:
        name = list(site)
        for _ in range(rng.randrange(1, 5)):
            place = rng.randrange(len(name))
            name[place : place + 1] = rng.choice([[], [rng.choice(letters)], [name[place], rng.choice(letters)]])
        typo.append("".join(name))
    named = LA._ranked(spark.createDataFrame([(s,) for s in sites], "domain string"), None)
    asked = N.with_letters(spark.createDataFrame([(t,) for t in set(typo)], "left string"), "left")
    measured = sum(N.piece_candidates(asked, named, d).count() for d in LA.PIECE_BOUNDS)
    assert measured < 0.01 * len(sites) * len(typo)
    found = {r["left"]: r["distance"] for r in N.nearest_by_pieces(asked, named, 4).collect()}
    assert all(found[t] <= edits(t, s) for t, s in list(zip(typo, sites))[::50])
