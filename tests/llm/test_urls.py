import math
import re

from lexgrid.llm import urls as M

URLS = [
    (1, "https://A.Example.NET/en/1?x=/de/"), (2, "http://example.net/EN/2"), (3, "https://xexample.net/en/1"), (4, "https://a.example.com/de/9#t"), (5, "https://example.org/fr/x"), (6, "https://org/fr/"), (7, "https://example.net"),
    (8, None), (9, ""), (10, "no scheme/en/"), (11, "a://b://c.net/"), (12, "https://example.com/en/page"), (12, "https://example.com/en/page"), (None, "https://u@h.net:80/p"), (13, "https://é.example.net/en/é?"),
]


def plain_split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    best = None
    for rule, says in M.RULES:
        own, _, below = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + below) and (best is None or len(rule) > len(best[0])):
            best = (rule, says)
    return best or (None, None)


def plain_scores(rows):
    """The two models by dictionaries: n-grams and contexts counted as strings."""
    counts, alphabet = {}, {M.END}
    for url, says in rows:
        s = M.MARK * M.ORDER + (url or "") + M.END
        alphabet |= set(url or "")
        if says:
            for i in range(M.ORDER, len(s)):
                for k in range(M.ORDER + 1):
                    for key in ((says, "gram", s[i - k : i + 1]), (says, "context", s[i - k : i])):
                        counts[key] = counts.get(key, 0) + 1
    out = []
    for url, _ in rows:
        s, total = M.MARK * M.ORDER + (url or "") + M.END, 0.0
        for i in range(M.ORDER, len(s)):
            p = {}
            for says in ("allow", "block"):
                x = 1 / len(alphabet)
                for k in range(M.ORDER + 1):
                    x = (counts.get((says, "gram", s[i - k : i + 1]), 0) + x * M.STRENGTH) / (counts.get((says, "context", s[i - k : i]), 0) + M.STRENGTH)
                p[says] = x
            total += math.log(p["allow"]) - math.log(p["block"])
        out.append(total / (len(s) - M.ORDER))
    return out


def test_chances_of_a_context_add_up(spark):
    """Every context of three characters: its chances are a distribution, whether it was seen or not."""
    import itertools

    seen = {"aaaab": (3, 1), "aaaac": (1, 0), "baaaa": (0, 5), "abcab": (2, 2)}
    rows = [("".join(g), *seen.get("".join(g), (0, 0))) for g in itertools.product("abc", repeat=M.ORDER + 1)]
    sums = {}
    for r in M.chances(spark.createDataFrame(rows, "gram string, good long, bad long")).collect():
        for name in ("p_good", "p_bad"):
            assert 0 < r[name] < 1
            sums[r.gram[:-1], name] = sums.get((r.gram[:-1], name), 0) + r[name]
    assert len(sums) == 2 * 3**M.ORDER and all(abs(x - 1) < 1e-12 for x in sums.values())


def test_a_very_long_url(spark):
    long = "https://a.test/" + "ab" * 40_000
    urls = [(1, "https://example.net/en/abab"), (2, "https://example.com/de/xyxy"), (3, long)]
    got = {r.page_id: r for r in M.judge(spark, spark.createDataFrame(urls, "page_id long, url string")).collect()}
    scores = plain_scores([(u, plain_rule(*plain_split(u))[1]) for _, u in urls])
    assert abs(got[3].score - scores[2]) < 1e-9 and got[3].verdict == "allow" and got[3].path == long[len("https://a.test") :]


def test_against_plain_python(spark):
    pages = spark.createDataFrame([(i, u, "h", 1.0) for i, u in URLS], "page_id long, url string, html string, score double")
    got = sorted(M.judge(spark, pages).collect(), key=lambda r: (r.page_id is None, r.page_id or 0))
    rows = []
    for i, u in sorted(URLS, key=lambda r: (r[0] is None, r[0] or 0)):
        host, path = plain_split(u)
        rows.append((i, u, host, path, *plain_rule(host, path)))
    scores = plain_scores([(r[1], r[5]) for r in rows])
    for g, r, s in zip(got, rows, scores, strict=True):
        assert (g.page_id, g.host, g.path, g.rule) == (r[0], r[2], r[3], r[4])
        assert abs(g.score - s) < 1e-9
        assert g.verdict == (r[5] or ("allow" if s >= g.threshold else "block"))


def test_without_labels_all_pass(spark):
    pages = spark.createDataFrame([(1, "https://example.org/de/"), (2, None)], "page_id long, url string")
    assert [(r.verdict, r.threshold) for r in M.judge(spark, pages).collect()] == [("allow", None)] * 2
    assert M.judge(spark, pages.limit(0)).count() == 0


def test_unruled_urls_follow_their_likeness(spark, sf):
    out = M.op2_urls(spark, sf)
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(r.verdict == ("allow" if r.score >= r.threshold else "block") for r in rows if r.rule is None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_every_ngram_has_its_own_count(spark):
    """More n-grams than 16,384 hashed cells could tell apart: unlike url texts still score by what they hold."""
    import random

    rng = random.Random(2)
    word = lambda letters: "".join(rng.choices(letters, k=40))
    old, new = "abcdefghijklm", "nopqrstuvwxyz"
    urls = [f"https://example.net/en/{word(old)}" for _ in range(1500)] + [f"https://example.com/de/{word(new)}" for _ in range(1500)]
    urls += [f"https://a.test/{word(old)}" for _ in range(50)] + [f"https://a.test/{word(new)}" for _ in range(50)]
    rows = [(i, u, None, None, *plain_rule(*plain_split(u))) for i, u in enumerate(urls)]
    got = sorted(M.judge(spark, spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")).collect(), key=lambda r: r.page_id)
    for g, score in zip(got, plain_scores([(r[1], r[5]) for r in rows]), strict=True):
        assert abs(g.score - score) < 1e-9
    assert [r.verdict for r in got[3000:]] == ["allow"] * 50 + ["block"] * 50
