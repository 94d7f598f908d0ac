import datetime
import random

import pandas as pd
import pytest

from noticeflow.llm import survivorship

SCHEMA = "client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, segment string, balance double"
DAY = datetime.datetime(2024, 3, 1)
TRUST = {"partner": 4, "store": 3, "web": 2, "crm": 1}
MONTH = datetime.timedelta(days=30)


def brute(rows):
    """Golden records one cluster at a time, straight from the rules."""
    clean = lambda x: x if x is not None and x.strip(" \t\n\x0b\x0c\r") else None
    clusters = {}
    for r in rows:
        client, master, source, at, name, email, city, nation, segment, balance = r
        record = dict(id=client, trust=TRUST.get(clean(source), 0), at=at, name=clean(name), email=clean(email), city=clean(city), nation=nation, segment=clean(segment), balance=balance)
        clusters.setdefault(client if master is None else master, []).append(record)
    out = set()
    for key, own in clusters.items():
        latest = max((r["at"] for r in own if r["at"]), default=None)
        for r in own:
            r["stale"] = r["at"] is None or r["at"] < latest - MONTH
        recent = lambda r: (r["at"] is None, -(r["at"] - DAY).total_seconds() if r["at"] else 0, -r["trust"], r["id"] is None, r["id"] or 0)
        trusted = lambda r: (r["stale"], -r["trust"], recent(r))

        def first(field, order, own=own):
            return min((r for r in own if r[field] is not None), key=order, default={field: None, "id": None})

        segment = first("segment", recent)
        email, name = first("email", trusted), first("name", lambda r: (-len(r["name"]), trusted(r)))
        balance = first("balance", lambda r: (segment["segment"] is None or r["segment"] != segment["segment"], recent(r)))
        address = min(own, key=lambda r: (-(r["city"] is not None) - (r["nation"] is not None), trusted(r)))
        out.add((
            key, len(own), sum(r["stale"] for r in own), name["name"], email["email"], segment["segment"], address["city"], address["nation"],
            None if balance["balance"] is None else int((100 * balance["balance"] + 0.5) // 1), name["id"], email["id"], segment["id"], balance["id"],
            address["id"] if address["city"] is not None or address["nation"] is not None else None,
        ))
    return out


def made(n, clusters, seed=3):
    r = random.Random(seed)
    some = lambda *xs: r.choice([None, *xs])
    rows = []
    for k in range(n):
        at = some(DAY, DAY - MONTH, DAY - MONTH - datetime.timedelta(microseconds=1), *(DAY - datetime.timedelta(hours=r.randint(0, 2000)) for _ in range(4)))
        master = 0 if r.random() < 0.35 else some(*range(clusters))
        rows.append((k, master, some("partner", "store", "web", "crm", "CRM", " "), at, some("Ann", "Bo", "\U0001f600\U0001f600\U0001f600", " ", "Ånń"), some("a@x", "b@x", "\t"), some("Oslo", "Bergen", ""), some(1, 2), some("retail", "online", "  "), some(1.005, -3.2, 0.0)))
    return rows


def collected(df):
    return {tuple(None if x is pd.NA else x for x in r) for r in df.collect()}


@pytest.mark.parametrize("large", [5, 10**9])
def test_golden_records_are_those_of_the_rules(spark, monkeypatch, large):
    monkeypatch.setattr(survivorship, "LARGE", large)
    monkeypatch.setattr(survivorship, "PARTS", 10)
    rows = made(600, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert collected(survivorship.golden(df)) == brute(rows)


def test_a_cluster_of_many_segments_and_ids_beyond_a_double(spark):
    big = (1 << 62) + 1
    rows = [(big + k, big, "web", DAY - datetime.timedelta(hours=k), "n" * (k % 5), None, None, None, f"s{k}", None if k == 0 else float(k)) for k in range(300)]
    got = collected(survivorship.golden(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and next(iter(got))[11] == big


def test_edges(spark):
    empty = survivorship.golden(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[0] == "cluster_id"
    rows = [(None, None, None, None, None, None, None, None, None, None)] * 2 + [(1, None, "web", DAY, "a", "e", "c", 3, "s", float("nan")), (2, 1, "crm", DAY, None, None, None, None, "s", float("inf"))]
    got = {r[0]: tuple(r) for r in survivorship.golden(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as cluster", "2 as n", "3 as trust", "'x' as stale", "0 as part")).collect()}
    assert got[None] == (None, 2, 2, *[None] * 11)
    assert got[1] == (1, 2, 0, "a", "e", "s", "c", 3, None, 1, 1, 1, None, 1)


def test_repeated_rows_count_each(spark):
    rows = [(1, 1, "web", DAY, "a", None, None, None, None, 2.5)] * 3
    assert collected(survivorship.golden(spark.createDataFrame(rows, SCHEMA))) == {(1, 3, 0, "a", None, None, None, None, 250, 1, None, None, 1, None)}


def test_survivors_are_few_and_pruning_again_changes_nothing():
    rows = made(5000, 1, seed=9)
    df = pd.DataFrame([{
        "cluster": 0, "clustered": True, "client": r[0], "known": True, "trust": TRUST.get(r[2], 0), "name": r[4], "email": r[5], "city": r[6], "nation": r[7], "segment": r[8], "balance": r[9],
        "chosen": r[8] == "retail", "stale": False, "tie": k, "at": k // 3, "n": 1, "n_stale": 0, "part": 0,
    } for k, r in enumerate(rows)]).astype({"nation": "Int32"})
    one = survivorship.survivors(df)
    assert len(one) <= 5 * 3 + 1 + 2 and one["n"].sum() == 5000
    halves = pd.concat([survivorship.survivors(df[:2000].reset_index(drop=True)), survivorship.survivors(df[2000:].reset_index(drop=True))], ignore_index=True)
    again = survivorship.survivors(halves)
    assert set(again["client"]) == set(one["client"]) and again["n"].sum() == 5000
