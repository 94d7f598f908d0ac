import random
import time

import numpy as np

from noticeflow.llm import passages


def brute_windows(values, least):
    out = []
    for p, v in enumerate(values):
        left = p
        while left > 0 and (values[left - 1] > v):
            left -= 1
        right = p
        while right + 1 < len(values) and values[right + 1] >= v:
            right += 1
        if right - left + 1 >= least:
            out.append((p, left, right))
    return out


def test_compact_windows_against_brute_force():
    r = random.Random(1)
    for least in (1, 3, 8, 13):
        texts = [[r.choice([r.getrandbits(63) | 1 << 40, 1 << 50]) for _ in range(r.randint(1, 120))] for _ in range(6)]
        flat, ends, want = [], [], []
        for t in texts:
            want += [tuple(x + len(flat) for x in w) for w in brute_windows(t, least)]
            flat += [*t, 0]
            ends.append(len(flat) - 1)
        got = passages.compact_windows(np.array(flat, np.uint64), np.array(ends), least)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def words(r, n):
    return [f"w{r.randrange(10**6)}" for _ in range(n)]


def test_finds_planted_passages(spark):
    r = random.Random(2)
    rows, want = [], {}
    for k in range(12):  # 51 words and more, in three texts each
        shared = words(r, 51 + 7 * (k % 4))
        for n in range(3):
            head = words(r, r.randint(0, 150))
            mine = list(shared)
            if k % 3 == 2 and n:
                mine[len(mine) // 2] = "edited"
            rows.append((100 * k + n, " ".join([*head, *mine, *words(r, r.randint(0, 150))])))
            want[100 * k + n] = (len(head), len(head) + len(mine), 100 * k)
    line = words(r, 40)
    rows += [(5000 + k, " ".join([*words(r, 60), *line, *words(r, 60)])) for k in range(30)]  # too short to count
    rows += [(6000 + k, " ".join(words(r, 200))) for k in range(30)]
    rows += [(7000, "a b"), (7001, "a b"), (7002, None), (7003, ""), (None, "lonely"), (7004, "spam " * 3000)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, th string, a int").repartition(5)
    got = passages.passages(docs).collect()
    exact = {i for i in want if i // 100 % 3 != 2}
    spans = {x.doc_id: (x.start, x.end, x.class_id) for x in got if x.kind == "passage"}
    assert exact <= set(spans) <= set(want)
    assert all(spans[i] == want[i] for i in exact)
    assert len(set(spans) - exact) >= 8  # of 12, of which the 8 with an edit are at a similarity of about 0.8
    assert all(x.end - x.start >= 51 for x in got if x.kind == "passage")
    assert sorted((x.doc_id, x.start, x.end, x.class_id) for x in got if x.kind == "copy") == [(7000, 0, 2, 7000), (7001, 0, 2, 7000), (7002, 0, 0, 7002), (7003, 0, 0, 7002)]


def test_large_group_links_to_one(spark):
    r = random.Random(3)
    shared = words(r, 60)
    rows = [(k, " ".join([*words(r, 30), *shared, *words(r, 30)])) for k in range(400)]
    got = passages.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()
    assert {x.doc_id for x in got} == set(range(400)) and {x.class_id for x in got} == {0} and {x.n_docs for x in got} == {400}


def test_empty(spark):
    assert passages.passages(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def equal_runs(texts, n):
    """Which words of each text are in a run of `n` words that another text has, and which texts share a run with which."""
    at = {}
    for k, t in enumerate(texts):
        for i in range(len(t) - n + 1):
            at.setdefault(tuple(t[i : i + n]), set()).add((k, i))
    covered, linked = [set() for _ in texts], set()
    for places in at.values():
        if len({k for k, _ in places}) > 1:
            for k, i in places:
                covered[k].update(range(i, i + n))
            linked |= {(k, m) for k, _ in places for m, _ in places if k < m}
    return covered, linked


def found(spark, texts, parts=6, **options):
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(parts)
    spans, classes = {}, {}
    for x in passages.passages(docs, **options).collect():
        if x.kind == "passage":
            spans.setdefault(x.doc_id, set()).update(range(x.start, x.end))
            classes.setdefault(x.doc_id, set()).add(x.class_id)
    return spans, classes


def test_all_equal_passages_around_a_frequent_line(spark):
    """Lines of 10 to 50 words that many texts have; some pairs of these share a passage around the line, at any place of it."""
    r = random.Random(5)
    texts = []
    for size in (10, 30, 44, 47, 50):
        line = words(r, size)
        for k in range(24):
            before, after = words(r, 60), words(r, 60)
            cut = r.randint(0, 51 - size)
            shared = [*before[60 - cut :], *line, *after[: 51 - size - cut]]
            texts += [[*words(r, r.randint(0, 40)), *shared, *words(r, r.randint(0, 40))] for _ in range(2 if k % 2 else 1)]
    periodic = words(r, 3)
    texts += [[*(periodic * 30), *words(r, 40)], [*words(r, 9), *(periodic * 20), *words(r, 4)], [*words(r, 70), *texts[0]]]
    again = {" ".join(t) for t in texts[-3:-1]}  # of these the ends of what they repeat may stay unmarked
    twice = words(r, 55)
    texts += [[*twice, *words(r, 5), *twice, *words(r, 60), *twice], [*words(r, 3), *twice]]
    r.shuffle(texts)
    covered, linked = equal_runs(texts, 51)
    assert len(linked) >= 60
    for parts in (9,):
        spans, classes = found(spark, texts, parts)
        assert all(c <= spans.get(k, set()) for k, c in enumerate(covered) if c and " ".join(texts[k]) not in again)
        assert all(len(c - spans.get(k, set())) < 0.2 * len(c) for k, c in enumerate(covered) if c)
        assert all(classes[k] & classes[m] for k, m in linked)
        assert all(covered[k] for k in spans)


def test_recall_of_near_copies_over_all_pairs(spark):
    """Pairs of texts with stretches of 51 words and more that are similar to 0.8 and more, by kind of edit."""
    r = random.Random(6)
    texts, kinds = [], {}
    line = words(r, 20)
    for k in range(160):
        n, kind = r.choice([60, 90, 150, 300]), ("word", "inserted", "deleted", "scattered", "line")[k % 5]
        one = words(r, n)
        if kind == "line":
            one[n // 3 : n // 3 + 20] = line
        two = list(one)
        if kind in ("word", "line"):
            two[r.randrange(n)] = "changed"
        elif kind == "inserted":
            at = r.randrange(10, n - 10)
            two[at:at] = words(r, r.randint(1, max(1, n // 8 - 5)))
        elif kind == "deleted":
            at = r.randrange(10, n - 10)
            del two[at : at + max(1, n // 12)]
        else:
            for _ in range(max(1, n // 60)):
                two[r.randrange(n)] = f"x{r.random()}"
        s, t = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (one, two))
        if min(len(one), len(two)) < 51 or len(s & t) < 0.8 * len(s | t):
            continue
        kinds.setdefault(kind, []).append((len(texts), len(texts) + 1))
        texts += [[*words(r, r.randint(0, 80)), *x, *words(r, r.randint(0, 80))] for x in (one, two)]
    spans, classes = found(spark, texts)
    recall = {kind: sum(bool(classes.get(a, set()) & classes.get(b, set())) for a, b in v) / len(v) for kind, v in kinds.items()}
    assert all(len(v) >= 10 for v in kinds.values()) and len(kinds) == 5
    every = [p for v in kinds.values() for p in v]
    assert sum(bool(classes.get(a, set()) & classes.get(b, set())) for a, b in every) >= 0.95 * len(every), recall
    assert min(recall.values()) >= 0.9, recall


def test_recall_of_passages_with_one_other_word(spark):
    """Passages of 51 to 60 words with one word changed, at a similarity of 0.81 to 0.84."""
    r, texts = random.Random(9), []
    for _ in range(400):
        one = words(r, r.choice((51, 55, 60)))
        two = list(one)
        two[r.randrange(8, len(one) - 8)] = "changed"
        texts += [[*words(r, r.randint(5, 40)), *x, *words(r, r.randint(5, 40))] for x in (one, two)]
    _, classes = found(spark, texts)
    assert sum(bool(classes.get(k, set()) & classes.get(k + 1, set())) for k in range(0, 800, 2)) >= 0.98 * 400


def test_links_that_no_support_can_reach_go_first():
    r = random.Random(10)
    rows = sorted((r.randrange(6), r.randrange(3), r.randrange(4), int(r.random() < 0.1)) for _ in range(60))
    x = {c: np.array(v, np.int64) for c, v in zip(("a", "b", "j", "wide"), zip(*rows))}
    got = passages._possible(x, 3)
    of = lambda row: [y for y in rows if y[:2] == row[:2]]
    assert list(zip(*(got[c].tolist() for c in x))) == [y for y in rows if any(z[3] for z in of(y)) or len({z[2] for z in of(y)}) >= 3]


def test_support_against_all_pairs():
    r = random.Random(7)
    for least in (3, 8):
        rows = []
        for _ in range(150):
            la, lb = r.randrange(40), r.randrange(40)
            rows.append((r.randrange(2), r.randrange(2), r.randrange(4), la, la + r.randrange(least - 1, 30), lb, lb + r.randrange(least - 1, 30)))
        rows.sort(key=lambda x: (x[0], x[1], x[3]))
        got = passages.supported({c: np.array(v, np.int32) for c, v in zip(("a", "b", "j", "la", "ra", "lb", "rb"), zip(*rows))}, least)
        want = [len({y[2] for y in rows if y[:2] == x[:2] and min(x[4], y[4]) - max(x[3], y[3]) + 1 >= least and min(x[6], y[6]) - max(x[5], y[5]) + 1 >= least}) for x in rows]
        assert got.tolist() == want


def test_support_up_to_what_is_needed():
    r = random.Random(11)
    for least in (3, 8):
        rows = []
        for _ in range(400):
            la, lb = r.randrange(60), r.randrange(60)
            rows.append((r.randrange(2), r.randrange(2), r.choice((0, 0, 0, 1, 2)), la, la + r.randrange(least - 1, 40), lb, lb + r.randrange(least - 1, 14)))
        rows.sort(key=lambda x: (x[0], x[1], x[3]))
        x = {c: np.array(v, np.int32) for c, v in zip(("a", "b", "j", "la", "ra", "lb", "rb"), zip(*rows))}
        want, asked = passages.supported(x, least), np.array([r.random() < 0.6 for _ in rows])
        for enough in (2, 3):
            got = passages.supported(x, least, enough, asked)
            assert ((got >= enough) == (want >= enough))[asked].all() and 0 < (want[asked] >= enough).sum() < asked.sum()


def test_support_in_proportion_to_the_links_of_two_texts():
    """Windows of all lengths, all around one place, as long texts have many: none has another function's in reach in both texts."""
    seconds = []
    for n in (2000, 16000):
        k = np.arange(n)
        x = {"a": np.zeros(n, np.int64), "b": np.zeros(n, np.int64), "j": k % 2, "la": k, "ra": n + 50 + k, "lb": k % 2 * 10**6 + k, "rb": k % 2 * 10**6 + n + 50 + k}
        begun = time.process_time()
        # The odd ones are far away in b; the last two meet.
        x["lb"][-2:], x["rb"][-2:] = 3 * 10**6, 3 * 10**6 + 100
        got = passages.supported({c: v.astype(np.int32) for c, v in x.items()}, 47, 2)
        seconds.append(time.process_time() - begun)
        assert got[:-2].max() == 1 and got[-2:].tolist() == [2, 2]
    assert seconds[1] < 24 * seconds[0] + 0.5, seconds  # 8 times the links


def test_steps_of_an_extension_are_found_once(monkeypatch):
    """But for the last ones, where the bound was too narrow before."""
    r, searched, next_common = random.Random(12), [], passages._next_common
    monkeypatch.setattr(passages, "_next_common", lambda a, b, most: searched.append((len(a), len(b), a.strides)) or next_common(a, b, most))
    for _ in range(40):
        one = [r.getrandbits(62) for _ in range(600)]
        two = [x if r.random() > 0.05 or k == 300 else r.getrandbits(62) for k, x in enumerate(one)]
        for _ in range(2):
            at = r.randrange(320, 580)
            two[at : at + r.randrange(3)] = [r.choice(one) for _ in range(r.randrange(10))]
        a, b, x, y = np.array(one), np.array(two), 300, 300
        searched.clear()
        passages.extend(a, b, x, y, 0.8)
        assert 10 < len(searched) <= len(set(searched)) + 6


def test_known_steps_are_those_of_any_bound():
    r = random.Random(13)
    for _ in range(300):
        few = r.choice((3, 40, 400))
        a, b = (np.array([r.randrange(few) for _ in range(r.randrange(1, 400))]) for _ in "ab")
        way = passages._Way(a, b)
        for _ in range(8):
            most = r.choice((0, 3, 15, 16, 40, 63, 64, 200, 300, 1000))
            u = len(np.intersect1d(a[: most + 1], b[: most + 1]))
            got = way.step(0, 0, 0, most)
            assert got == passages._next_common(a, b, most) and (got is not None or not u)
            if got:
                assert a[got[0]] == b[got[1]] and max(got) <= most
