import random
import zlib

from noticeflow.llm import toxicity


def test_misspelled_forms_of_a_stem(spark):
    r = random.Random(4)
    rows, labels = [], []
    for k in range(300):
        body = [f"w{r.randrange(10**5)}" for _ in range(20)]
        if k % 3 == 0:
            body[5] = r.choice(["idiots", "idiot"])
        rows.append((k, " ".join(body)))
        labels.append((k, int(k % 3 == 0)))
    wrong = ["idoit", "ediot", "idot", "ideots"]
    new = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 3 == 1][: len(wrong) + 1]
    rows += [(i, f"some plain words and {w} among them") for i, w in zip(new, [*wrong, "nothing"], strict=True)]
    docs, lab = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, lab)
    assert "idiot" not in model.terms and any("idiot".startswith(t[:-1]) for t in model.terms if t.endswith("*"))
    score = {x.doc_id: x.score for x in toxicity.score(docs, model).collect() if x.doc_id in new}
    assert all(score[i] > score[new[-1]] for i in new[:-1])
