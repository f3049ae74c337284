import random

from shopspan.llm import hostquality
from tests.llm.conftest import words_of


def brute(text):
    t = text or ""
    w = words_of(t)
    seen = {}
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeated = {i + k for places in seen.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in t.split("\n") if words_of(x)]
    failed = len(w) < 20 or 100 * len(repeated) > 30 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated), failed)


def texts_of(prose):
    rng = random.Random(4)
    out = [None, "", " \n ", "a\n\na\n a\na", "x " * 19, "x " * 20, "# | <b> & %%\n" * 30, "é\x0bß\x0c\x1cü\x85z " * 9]
    for k in range(40):
        part = prose(k, rng.randint(5, 40))
        out.append("\n".join([prose(k + 100, rng.randint(0, 60)), part, prose(k + 200, 12)] + [part] * rng.randint(0, 3)))
    return out


def test_measures_equal_counting(spark, prose):
    texts = texts_of(prose)
    docs = spark.createDataFrame([(k, t, f"s{k % 3}") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in hostquality.judge(docs).collect():
        assert tuple(r[m] for m in hostquality.MEASURES) == brute(texts[r.doc_id]), repr(texts[r.doc_id])[:80]


def test_host_verdicts_shrink(spark, prose):
    good, bad = prose(1, 60), "too short"
    rows = [(k, good, "good") for k in range(300)] + [(1000 + k, bad if k % 10 else good, "bad") for k in range(100)]
    rows += [(2000, bad, "tiny"), (2001, good, "tiny"), (3000, good, None), (3001, bad, None)]
    rows += [(4000 + k, bad if k % 25 == 0 else good, f"h{k % 20}") for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r for r in hostquality.judge(docs).collect()}
    hosts = {}
    for d, t, s in rows:
        if s:
            n, f = hosts.get(s, (0, 0))
            hosts[s] = (n + 1, f + (t == bad))
    total, fails = sum(n for n, _ in hosts.values()), sum(f for _, f in hosts.values())
    mean = fails / total
    between = (sum(n * (f / n - mean) ** 2 for n, f in hosts.values()) - len(hosts) * mean * (1 - mean)) / total
    k = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6)
    for d, t, s in rows:
        shrunk = (hosts[s][1] + mean * k) / (hosts[s][0] + k) if s else None
        assert (got[d].shrunk_rate is None) == (s is None)
        if s:
            assert abs(got[d].shrunk_rate - shrunk) < 1e-9
        assert got[d].kept == (t == good and (s is None or shrunk <= 0.5))
    assert not got[1000].kept and got[2001].kept and got[3000].kept
    kept = hostquality.without_failures(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_odd_rows(odd_docs):
    got = hostquality.judge(odd_docs).collect()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert len(got) == len(odd_docs.collect())
    for r in got:
        if r.doc_id is not None:
            assert tuple(r[m] for m in hostquality.MEASURES) == brute(texts[r.doc_id])
    kept = hostquality.without_failures(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.kept}
    assert hostquality.judge(odd_docs.limit(0)).count() == 0
    assert hostquality.without_failures(odd_docs.limit(0)).count() == 0


def test_no_python_in_the_plan(odd_docs):
    plan = hostquality.measured(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
