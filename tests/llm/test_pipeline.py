import random
from collections import Counter, defaultdict

import corpus_pipeline
from noticeflow.llm import mixing, secrets

BAD = ["idiot", "scum", "moron"]


def table(seed=1):
    r = random.Random(seed)
    words = lambda n: [f"w{r.randrange(10**5)}" for _ in range(n)]
    rows, toxic = [], {}
    for k in range(240):
        body = words(r.randint(30, 90))
        if toxic.setdefault(k, k % 6 == 0):
            for _ in range(4):
                body.insert(r.randrange(len(body)), r.choice(BAD))
        rows.append([k, " ".join(body), "en", f"src{k % 4}"])
    for k in range(40):  # near copies of clean texts, one word of them changed
        body = rows[6 * k % 240 + 1][1].split(" ")
        body[r.randrange(len(body))] = "changed"
        rows.append([300 + k, " ".join(body), "en", "src1"])
    rows += [[400, rows[1][1], "en", "src2"], [401, "token = deadbeefdeadbeef01 " + " ".join(words(30)), "de", "src3"], [402, None, None, None], [403, "", "en", "src0"], [None, " ".join(words(20)), "en", "src0"], [404, "long " * 30_000, "en", "src0"]]
    return rows, toxic


def brute_groups(rows, similarity=0.8):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if ((rows[i][1] or "") == (rows[j][1] or "") or both and both >= similarity * (len(sets[i]) + len(sets[j]) - both)) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    best = defaultdict(list)
    for k, g in enumerate(group):
        best[g].append((rows[k][0] is None, rows[k][0]))
    return {min(v, key=lambda x: (x[0], x[1] or 0))[1] for v in best.values()}


def test_stages(spark, tmp_path):
    rows, toxic = table()
    shape = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, h long, n long, size long"
    docs = spark.createDataFrame([(*x, len(x[1] or ""), "r", 1, 2, 3, 4) for x in rows], shape).repartition(5)
    spark.createDataFrame([(k, int(y)) for k, y in toxic.items()], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "mixing", "packing"]
    read = lambda name, df: (df.write.parquet(str(tmp_path / name)), spark.read.parquet(str(tmp_path / name)))[1]

    civil = read("1", stages["toxicity"](spark, docs, str(tmp_path)))
    left = {x.doc_id for x in civil.collect()}
    assert civil.columns == docs.columns and left == {i for i, *_ in rows if not toxic.get(i, False)}

    own = [x for x in rows if x[0] in left]
    single = read("2", stages["simhash_near_dedup"](spark, civil, str(tmp_path)))
    kept = {x.doc_id for x in single.collect()}
    want = brute_groups(own)
    assert single.columns == docs.columns and single.count() == len(kept) and want <= kept and len(kept - want) <= 0.1 * (len(own) - len(want)) + 1

    masked = read("3", stages["secret_scans"](spark, single, str(tmp_path)))
    texts = {x.doc_id: x.text for x in single.collect()}
    guesser = secrets.Guesser(secrets.lexicon(single))
    for x in masked.collect():
        assert x.text == (None if texts[x.doc_id] is None else secrets.masked(texts[x.doc_id], guesser)) and (x.row, x.id, x.h, x.n, x.size) == ("r", 1, 2, 3, 4)
    assert masked.count() == single.count() and masked.columns == docs.columns

    mixed = read("4", stages["mixing"](spark, masked, str(tmp_path)))
    copies = {x.doc_id: x.copies for x in mixing.mix(masked).collect() if x.copies}
    assert mixed.columns == docs.columns and Counter(x.doc_id for x in mixed.collect()) == copies and max(copies.values()) <= 3

    packed = read("5", stages["packing"](spark, mixed, str(tmp_path))).collect()
    assert Counter(x.doc_id for x in packed if x.piece == 0) == copies
    room = Counter()
    for x in packed:
        room[x.sequence_id] += x.length
    assert max(room.values()) <= 1024 and len(room) <= 1.05 * sum(room.values()) / 1024 + 1


def test_run_and_empty_tables(spark, tmp_path):
    rows, toxic = table(2)
    docs = spark.createDataFrame([(*x, len(x[1] or "")) for x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(k, int(y)) for k, y in toxic.items()], "doc_id long, toxic int")
    for name, d, lab in (("full", docs, labels), ("empty", docs.limit(0), labels.limit(0))):
        d.write.parquet(str(tmp_path / name / "documents.parquet"))
        lab.write.parquet(str(tmp_path / name / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "full")).count() > 150
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []
