import collections
import itertools
import random
import re

from matchmart.llm import urls


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, own string")


def test_given_rules(spark):
    rows = [(1, "https://a.net/x"), (2, "http://www.EXAMPLE.net/en/1?q=1"), (3, "http://example.net/fr/"), (4, "http://net"),
            (5, "ftp://b.example.com/de/#t"), (6, "http://x.org/fr/a"), (7, "http://notexample.com/de/"), (8, None),
            (9, "example.net/en/"), (10, ""), (11, "http://a.net?x=/"), (None, "x://y.net/"), (1, "https://a.net/x")]
    out = urls.judge(pages(spark, rows), spark.createDataFrame([], "url string, blocked boolean")).collect()
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in out)
    want = []
    for page, url in rows:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
        best = max(((len(h + p), h + p, v) for h, p, v in urls.RULES
                    if (host == h or host.endswith("." + h)) and path.startswith(p)), default=(0, None, "allow"))
        want.append((str(page), host, path, str(best[1]), best[2]))
    assert got == sorted(want)


def test_mined_rules(spark):
    rows = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.site.com/{'ads' if i % 4 == 0 else 'en'}/{i}?id={i}")
            for i in range(600)]
    labels = spark.createDataFrame([(u, i % 12 == 0) for i, u in rows], "url string, blocked boolean")
    out = {r.page_id: r for r in urls.judge(pages(spark, rows), labels, ()).collect()}
    assert all((out[i].verdict == "block") == (i % 12 == 0) for i, _ in rows)
    # Below the support there is no rule.
    out = urls.judge(pages(spark, rows), labels, (), min_pages=100).collect()
    assert {r.verdict for r in out} == {"allow"}


def test_pruned_to_the_shortest_rule(spark):
    rows = [([f"h:{'bad' if i % 2 else 'ok'}", "p:a", f"p:{i % 3}"], i % 2 == 1) for i in range(300)]
    mined = urls.mine_rules(spark.createDataFrame(rows, "items array<string>, blocked boolean")).collect()
    assert [r["items"] for r in mined] == [["h:bad"]]
    assert mined[0].key == "h:bad"


def test_empty(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert urls.judge(pages(spark, []), none).collect() == []


def test_labels_follow_the_document_in_the_url(spark, tmp_path):
    # Document numbers run against the page numbers; the blocked ones are all on one host.
    n = 200
    rows = [(i, f"http://{'bad' if i % 4 == 0 else 'good'}.site.io/en/{n - 1 - i}{['', '/', '.html'][i % 3]}?id=1#top")
            for i in range(n)] + [(n, "http://bad.site.io/other/7"), (n + 1, f"http://good.site.io/en/{'9' * 30}"), (n + 2, None)]
    pages(spark, rows).select("page_id", "url").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(n - 1 - i, 0 if i % 4 == 0 else 1, 0) for i in range(n)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = {r.page_id: r.verdict for r in urls.op7_url_filter(spark, str(tmp_path)).collect()}
    assert out == {i: "block" if u and "//bad." in u else "allow" for i, u in rows}


def test_mined_verdicts_equal_counting_all_token_sets(spark):
    """Rules worked out by counting every set of tokens of every labelled url."""
    rng = random.Random(6)
    rows = []
    for i in range(400):
        host = rng.choice(["bad", "good", "fine"])
        part = rng.choice(["ads", "en", "buy"])
        tail = rng.choice(["x", "y", "z", "w"])
        rows.append((i, f"http://{host}.site/{part}/{tail}", rng.random() < (0.95 if (host, part) == ("bad", "ads") or
                                                                           (part, tail) == ("buy", "z") else 0.1)))
    labelled, least = rows[:300], 8
    tokens = {u: {*(f"h:{x}" for x in u.split("/")[2].split(".")), *(f"p:{x}" for x in u.split("/")[3:])} for _, u, _ in rows}
    seen, bad = collections.Counter(), collections.Counter()
    for _, u, blocked in labelled:
        for n in range(1, len(tokens[u]) + 1):
            for s in itertools.combinations(sorted(tokens[u]), n):
                seen[s] += 1
                bad[s] += blocked
    rules = [set(s) for s in seen if bad[s] >= least and bad[s] / seen[s] >= urls.MIN_CONFIDENCE]
    table = spark.createDataFrame([(u, b) for _, u, b in labelled], "url string, blocked boolean")
    out = {r.page_id: r.verdict for r in urls.judge(pages(spark, [r[:2] for r in rows]), table, (), min_pages=least).collect()}
    want = {i: "block" if any(r <= tokens[u] for r in rules) else "allow" for i, u, _ in rows}
    assert out == want and 20 < list(want.values()).count("block") < 200
