"""URL rules by hand-made cases, host reputation against plain Python."""
from collections import defaultdict

from tillroll.llm import url_filter
from tillroll.llm.url_filter import RULES, Reputation

CASES = [  # url, host, path, rule
    ("http://Example.COM/en/1", "example.com", "/en/1", "example.com/en/"), ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("http://a.www.example.com/en/x?q#f", "a.www.example.com", "/en/x", "www.example.com/en/"), ("https://notexample.com/en/", "notexample.com", "/en/", "com/"),
    ("http://com/x", "com", "/x", "com/"), ("http://shop.com", "shop.com", "", None), ("http://shop.com?x=/", "shop.com", "", None),
    ("http://x.net/es/1", "x.net", "/es/1", "net/es/"), ("http://x.net/es", "x.net", "/es", None), ("http://x.net/fr/", "x.net", "/fr/", "net/fr/"),
    ("mailto:a@b.com", "", "", None), (None, "", "", None), ("", "", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ("http://ÄB.com/ü", "Äb.com", "/ü", "com/"), ("http://x.com:80/", "x.com:80", "/", None), ("http://#f", "", "", None), ("x://y.org/" + "p" * 5000, "y.org", "/" + "p" * 5000, None),
]


def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "clash", 1) for i, u in enumerate(urls)], "page_id long, url string, host string, rule string, n int")


def test_rules_and_parts(spark):
    got = {r.page_id: r for r in url_filter.judge(_pages(spark, [c[0] for c in CASES]), RULES).collect()}
    said = dict(RULES)
    for i, (_, host, path, rule) in enumerate(CASES):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), CASES[i]
        assert r.verdict in ("allow", "block") and (rule is None or r.verdict == said[rule])


def _posterior(outcomes, rep=Reputation()):
    """Plain-Python shrinkage; outcomes: host -> (n, k)."""
    domain = {h: ".".join(h.split(".")[-2:]) for h in outcomes}
    suffix = {d: d.partition(".")[2] for d in domain.values()}

    def add(pairs):
        out = defaultdict(lambda: [0, 0])
        for key, (n, k) in pairs:
            out[key][0] += n
            out[key][1] += k
        return out

    ds = add((domain[h], v) for h, v in outcomes.items())
    ss = add((suffix[d], v) for d, v in ds.items())
    top = add((0, v) for v in ss.values())[0]

    def strength(children, parent):
        a = b = c = 0.0
        for key, (n, k) in children.items():
            if n:
                pn, pk = parent(key)
                m = pk / pn
                a, b, c = a + n * (k / n - m) ** 2, b + m * (1 - m), c + m * (1 - m) * (n - 1)
        rho = (a - b) / c if c > 0 else 0
        rho = min(max(rho, 1 / (rep.strength_max + 1)), 1 / (rep.strength_min + 1))
        return 1 / rho - 1

    shrink = lambda v, m, s: (v[1] + s * m) / (v[0] + s)
    m0 = (top[1] + 1) / (top[0] + 2)
    s1, s2, s3 = strength(ss, lambda _: top), strength(ds, lambda d: ss[suffix[d]]), strength(outcomes, lambda h: ds[domain[h]])
    mean = {}
    for h, v in outcomes.items():
        md = shrink(ds[domain[h]], shrink(ss[suffix[domain[h]]], m0, s1), s2)
        mean[h] = shrink(v, md, s3)
    return mean


def test_posteriors_equal_plain_python(spark):
    counts = {"a.x.com": (20, 18), "b.x.com": (2, 0), "c.y.com": (0, 0), "d.y.com": (9, 1), "e.z.org": (30, 30), "f.z.org": (0, 0), "g.w.org": (1, 0)}
    rows = [(h, 1 if i < k else 0) for h, (n, k) in counts.items() for i in range(n)] + [(h, None) for h in counts]
    got = {r.host: r for r in url_filter.host_posteriors(spark.createDataFrame(rows, "host string, bad int")).collect()}
    for h, m in _posterior(counts).items():
        assert abs(got[h].mean - m) < 1e-9
        assert got[h].lower < got[h].mean


def test_reputation_decides_unruled_pages(spark):
    urls = ["http://bad.net/es/1"] * 30 + ["http://bad.net/other"] + ["http://good.com/a"] * 30 + ["http://good.com"]
    got = {r.page_id: r.verdict for r in url_filter.judge(_pages(spark, urls), RULES).collect()}
    assert got[30] == "block" and got[61] == "allow"


def test_empty_table_and_two_label_suffixes(spark):
    assert url_filter.judge(_pages(spark, []), RULES).count() == 0
    d = spark.createDataFrame([("a.b.co.uk:8080",), ("localhost",), ("",), ("x.y.z.com",)], "h string")
    assert [r[0] for r in d.select(url_filter.registered_domain(d["h"])).collect()] == ["b.co.uk", "localhost", "", "z.com"]
