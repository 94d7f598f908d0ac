import hashlib
import random
from difflib import SequenceMatcher
from urllib.parse import parse_qsl, urlencode, urlsplit, urlunsplit

import datetime

import pytest
from pyspark.sql import functions as F

from noticeflow import rules
from noticeflow.functions import similarity
from noticeflow.functions import text as T
from noticeflow.functions import time as D
from noticeflow.functions import url as U


def column(spark, values, f, kind="string"):
    rows = [(k, v) for k, v in enumerate(values)]
    return [r[0] for r in spark.createDataFrame(rows, f"k int, v {kind}").orderBy("k").select(f(F.col("v"))).collect()]


def url_by_library(raw):
    parts = urlsplit(raw.strip())
    query = [(k, v) for k, v in parse_qsl(parts.query, keep_blank_values=True) if not k.lower().startswith("utm_") and k.lower() not in rules.TRACKING_KEYS]
    return urlunsplit((parts.scheme.lower(), parts.netloc.lower(), parts.path.rstrip("/") or "/", urlencode(query), ""))


def test_normalize_url(spark):
    r = random.Random(4)
    pieces = ["a", "B", "%41", "%", "%zz", "公告", "a b", "~", "*", "+", ".", "-", "_", "1"]
    urls = ["HTTP://A.com", "https://a.com/x/?utm_source=1&b=2", "  http://a.com/p//#f ", "http://a.com/?t=1&T=2&SPM=3&q=", "http://a.com/p?a=1&a=1&b", "http://a.com?x=1&&y=2"]
    for _ in range(400):
        w = lambda: "".join(r.choice(pieces) for _ in range(r.randint(0, 3)))
        query = "&".join(r.choice([f"{w()}={w()}", f"utm_x={w()}", f"From={w()}", w(), f"k={w()}={w()}"]) for _ in range(r.randint(0, 4)))
        urls.append(f"{r.choice(['http', 'HTTPS'])}://{r.choice(['a.COM', 'b.cn:8080'])}/{w()}/{w()}{r.choice(['', '/', '//'])}?{query}{r.choice(['', '#x?y'])}")
    assert column(spark, urls, U.normalize_url) == [url_by_library(u) for u in urls]
    assert column(spark, [None], U.normalize_url) == ["/"]


def test_fingerprint_and_base(spark):
    titles = ["关于 XX医院（采购）-公告_1", "A.b C!", None, "", "中标公告：过敏原 试剂", "Ⅻ①²"]
    assert column(spark, titles, T.title_fingerprint) == ["关于xx医院采购公告1", "abc", "", "", "中标公告过敏原试剂", "ⅻ①²"]
    assert column(spark, titles[4:5], T.title_base) == ["公告过敏原试剂"]


def test_rules(spark):
    cases = ["抗体ANA检测", "ANA 检测", "(ELISA)试剂", "特异性　IgE", "SIGE", "化学发光12345678试剂", "化学发光123456789试剂", "免疫荧光", None, "全自动酶免"]
    got = column(spark, cases, lambda c: T.all_matches(c, rules.SIGNALS))
    assert got == [[], ["自身抗体/自身免疫试剂"], ["酶联免疫(ELISA)试剂"], ["过敏原sIgE试剂"], ["过敏原sIgE试剂"], ["化学发光免疫"], [], ["免疫荧光/免疫印迹"], [], ["免疫分析仪器"]]
    assert column(spark, ["食材和食堂", "科普与物业服务", "采购"], lambda c: T.first_match(c, rules.EXCLUSIONS)) == ["食堂.*食材|食材.*食堂", "物业服务", None]
    assert column(spark, ["某院采购公告", "新闻"], lambda c: T.has_any(c, rules.INTENT_WORDS)) == [True, False]


def test_ids_and_teasers(spark):
    assert column(spark, ["http://a.com"], T.candidate_id) == ["C" + hashlib.sha256(b"http://a.com").hexdigest()[:12].upper()]
    assert column(spark, [" a\nb ", "x" * 10, "y" * 5, None], lambda c: T.truncate(c, 5)) == ["a b", "xxxx…", "yyyyy", ""]
    made = column(spark, ["k1", "k2"], lambda c: T.record_id(F.lit(datetime.date(2026, 8, 11)), c))
    assert all(m.startswith("T20260811-") and len(m) == 16 for m in made) and made[0] != made[1]
    assert column(spark, [*made, "T20260811-K7X2P0", "T2026081-K7X2P9", " T20260811-K7X2P9", None], T.is_record_id) == [True, True, False, False, False, False]


def test_links_and_contacts(spark):
    html = '<a href="/a/b.PDF">x</a><a href="https://oss.other.com/c.docx">y</a><A HREF="d.zip"><a href="e.html">联系 0991-4881798</a><script>0991-1111111</script>'
    assert column(spark, [html, None], U.links) == [["/a/b.PDF", "https://oss.other.com/c.docx", "d.zip"], []]
    page = F.lit("http://h.cn/p/q.html?x=1")
    assert column(spark, ["/a/b.pdf", "https://o.com/c", "d.zip", "//k.cn/z"], lambda c: U.absolute(c, page)) == ["http://h.cn/a/b.pdf", "https://o.com/c", "http://h.cn/p/d.zip", "http://k.cn/z"]
    assert column(spark, [html, "<p>none</p>"], T.contact) == ["0991-4881798", "null"]
    assert column(spark, ["<td>联系人：</td><td>王小明</td><p>联 系 人: 李老师 0991-4881798</p>", "<p>none</p>"], T.contact_name) == ["李老师", "null"]


def test_times(spark):
    given = ["2026-08-19T10:30:00+08:00", "2026-08-19T10:30:00Z", "2026-08-19T10:30:00", "2026-08-19 10:30:00+0800", "20260819T103000+0800", "2026-08-19T10+08", "2026-13-19T10:30Z", "yesterday", None]
    assert [x is not None for x in column(spark, given, D.zoned)] == [True, True, False, True, True, True, False, False, False]
    now = F.to_timestamp(F.lit("2026-08-19 08:00:00"))
    assert column(spark, ["2026-08-19T09:00", "2026-07-15T09:30", "null", "soon"], lambda c: D.overdue(F.lit("active"), c, now)) == [False, True, False, False]
    today = datetime.date(2026, 8, 18)
    assert D.time_range("7d", today) == "2026-08-11..2026-08-18" and D.time_range("none", today) is None and D.time_range("OneWeek", today) == "OneWeek"
    assert D.time_range(" 45d ", today) == "2026-07-04..2026-08-18" and D.time_range("2026-08-01..2026-08-10", today) == "2026-08-01..2026-08-10"
    for bad in ("2026-08-02..2026-08-01", "x", "d", "-3d", "2026-08-01", "20260801..20260802", "2026-02-30..2026-03-01", "a..b..c"):
        with pytest.raises(ValueError):
            D.time_range(bad, today)
    assert column(spark, ["2019-001", "2026-1", "none"], lambda c: D.stale(c, F.lit("null"), F.lit("null"), now)) == [True, False, False]


def edited(r, s, times):
    for _ in range(times):
        k = r.randint(0, len(s))
        s = r.choice([s[:k] + r.choice("abxy中1") + s[k:], s[:k] + s[k + 1 :], s[k:] + s[:k] if r.random() < 0.2 else s])
    return s


def test_similarity_is_the_library_ratio(spark):
    r = random.Random(1)
    some = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    pairs = [("", ""), ("", "a"), ("abcd", "abcd"), ("qabxcd", "abycdf"), ("\U0001f600a中", "中\U0001f600a")]
    for _ in range(250):
        a = some(r.choice(["ab", "abcdef", "abcdefghijklmnop中文字"]), r.randint(0, 40))
        pairs.append((a, edited(r, a, r.randint(0, 6)) if r.random() < 0.6 else some("abcd", r.randint(0, 30))))
    for n in (199, 200, 201, 230, 330):  # from 200 on, frequent characters of the second one start no block
        for letters in ("ab", "abcdefghijklmnopqrstuvwxyz0123456789中文字母"):
            a = some(letters, n)
            pairs += [(a, edited(r, a, k)) for k in (0, 4, 30)] + [(a, some(letters, n))]
    got = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string").repartition(4).select("k", similarity.similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert {x.k: x.s for x in got} == {k: SequenceMatcher(None, a, b).ratio() for k, (a, b) in enumerate(pairs)}


def rule_by_rule(ordered):
    return lambda c: F.array_compact(F.array(*[F.when(T.matches(c, x), F.lit(x.name)) for x in ordered]))


def test_many_rules_in_one_scan_say_what_each_says(spark):
    r = random.Random(7)
    parts = ["免疫", "荧光", "质控品", "化学发光", "分析仪", "sIgE", "SıGE", "ANA", "ana", " ", "1234567", "总", "　", "IgE", "Kit", "\u212ait", "职工", "体检", "食堂", "食材", "科普", "双链", "DNA", "印迹", "仪", "\n"]
    texts = [None, ""] + ["".join(r.choice(parts) for _ in range(r.randint(0, 9))) for _ in range(400)]
    odd = (rules.Rule("kit", "kit|免疫荧光"), rules.Rule("any", r"[0-9]{7}"), rules.Rule("more", "免疫|免疫荧光|免疫荧光免疫"))
    for ordered in (rules.SIGNALS, rules.EXCLUSIONS, odd):
        want = column(spark, texts, rule_by_rule(ordered))
        assert column(spark, texts, lambda c, o=ordered: T.all_matches(c, o)) == want
        assert column(spark, texts, lambda c, o=ordered: T.first_match(c, o)) == [w[0] if w else None for w in want]
    words = ("免疫", "免疫荧光", "荧光免疫", "Kit", "kit", "1234", "a.b", "-^]")
    assert column(spark, [*texts, "xa.bx", "axb", "-^]"], lambda c: T.words_in(c, words)) == [[w for w in words if t and w in t] for t in [*texts, "xa.bx", "axb", "-^]"]]
    assert column(spark, ["x"], lambda c: T.words_in(c, ())) == [[]]


def test_contacts_stand_in_the_last_line_that_names_one(spark):
    pages = [
        "<p>联系人：甲乙丙 0991-1111111</p><div>x</div><tr><td>联系人：</td><td>王小明</td></tr><p>电话 0991-2222222</p><p>0991-3333333</p>",
        "<p>0991-1111111</p><p>经办人: 李老师</p>", "<p>0991-1111111</p><p>0991-2222222 13812345678</p>", "<!-- 联系人：甲乙 --><script>联系人：甲乙</script>", None,
    ]
    got = column(spark, pages, T.contacts)
    assert [(x.name, x.phone) for x in got] == [("王小明", "0991-2222222"), ("李老师", "0991-1111111"), ("null", "13812345678"), ("null", "null"), ("null", "null")]
