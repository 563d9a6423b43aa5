"""Rules against plain Python; the model against a direct computation of its probabilities."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from devicepulse.llm import url_filter as u

URLS = [
    None,
    "",
    "nothing",
    "http://A.Example.NET/en/x?y#z",
    "http://example.net/en/",
    "http://example.net/fr/",
    "https://net/x",
    "https://xnet/x",
    "https://a.net",
    "https://a.net?x=/",
    "https://fr.org/fr/a",
    "https://org/fr/",
    "https://org/fr",
    "http://sub.example.com/de/1#a://b/c",
    "http://badexample.com/de/1",
    "http://h#f",
    "x://y://z/w",
    "http://ÄB.net/\n/é",
    "http://user@a.net:80/p",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    end = min((path.find(c) for c in "?#" if c in path), default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), path[:end]


def ruled(host, path):
    fits = [
        r for r in u.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_hosts_paths_and_rules(spark):
    schema = "page_id int, url string, score double, _letters string, _rule int"
    pages = spark.createDataFrame([(i, x, 0.5, "a", 1) for i, x in enumerate(URLS)], schema)
    rows = u.judge(pages).collect()
    assert all(r._letters == "a" and r._rule == 1 for r in rows)
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = split(URLS[r.page_id])
        rule = ruled(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule.text if rule else None)
        assert r.verdict in ("allow", "block") if rule is None else r.verdict == rule.verdict


def test_probabilities(spark):
    rnd = random.Random(2)
    counts = Counter(("".join(rnd.choices("ab", k=4)), rnd.random() < 0.4) for _ in range(60))
    grams = sorted({g for g, _ in counts})
    rows = [(g, counts[g, True], counts[g, False]) for g in grams]

    def p(gram, kept):
        seen = defaultdict(Counter)
        for g in grams:
            for order in range(4):
                seen[g[3 - order : 3]][g[3], order] += counts[g, kept]
        prob = 1 / 39
        for order in range(4):
            context = gram[3 - order : 3]
            follow = {c: n for (c, o), n in seen[context].items() if o == order and n}
            total, kinds = sum(follow.values()), len(follow)
            if total:
                prob = (follow.get(gram[3], 0) + kinds * prob) / (total + kinds)
        return prob

    got = u._probabilities(spark.createDataFrame(rows, "gram string, kept bigint, dropped bigint")).collect()
    assert len(got) == len(grams)
    for r in got:
        assert abs(r.ratio - math.log(p(r.gram, True) / p(r.gram, False))) < 1e-9


def test_threshold(spark):
    rows = [(-1.0, "block", 5), (-0.5, "allow", 1), (-0.25, "block", 2), (0.5, "allow", 7)]
    scored = spark.createDataFrame(rows, "score double, verdict string, n bigint")
    assert -0.25 < u._threshold(scored) <= 0.5
    assert u._threshold(scored.where("verdict = 'allow'")) == float("-inf")


def test_a_model_tells_classes_apart(spark):
    rnd = random.Random(4)
    good, bad = ["garden", "flower", "meadow"], ["zxqvk", "qqzzx", "xkcdz"]
    rows = [(f"http://{rnd.choice(good)}{rnd.choice(good)}.org/fr/{i}",) for i in range(300)]
    rows += [(f"http://{rnd.choice(bad)}{rnd.choice(bad)}.net/{i}",) for i in range(300)]
    open_ = [("http://flowergarden.info/fr/1",), ("http://meadowmeadow.info/fr/7",), ("http://zxqvkqqzzx.info/3",)]
    pages = spark.createDataFrame(rows + open_ * 2 + [open_[0]] * 400, "url string")
    verdicts = {r.url: r.verdict for r in u.judge(pages).where(F.col("rule").isNull()).collect()}
    assert verdicts[open_[0][0]] == verdicts[open_[1][0]] == "allow" and verdicts[open_[2][0]] == "block"
    assert u.judge(pages).count() == pages.count()


def test_no_rows_no_rules_and_long_urls(spark):
    none = spark.createDataFrame([], "page_id int, url string")
    assert u.judge(none).collect() == []
    one = spark.createDataFrame([(1, "http://a.com/" + "x" * 50_000)], "page_id int, url string")
    assert [r.verdict for r in u.judge(one, ()).collect()] == ["allow"]


def test_a_class_that_a_fold_lacks(spark):
    rnd = random.Random(6)
    good, bad = ["garden", "flower", "meadow"], ["zxqvk", "qqzzx", "xkcdz"]
    rows = [(f"http://{rnd.choice(good)}{rnd.choice(good)}.org/fr/{'a' * (i % 40)}",) for i in range(200)]
    few = [(f"http://{rnd.choice(bad)}{rnd.choice(bad)}.net/{'b' * i}",) for i in range(40)]
    letters = spark.createDataFrame(few, "url string").withColumn("fold", u._fold(u._letters(F.col("url"))))
    some = [(r.url,) for r in letters.where("fold > 1").collect()]
    open_ = [("http://flowergarden.info/fr/",), ("http://zxqvkqqzzx.info/b",)]
    pages = spark.createDataFrame(rows + some + open_, "url string")
    verdicts = {r.url: r.verdict for r in u.judge(pages).where(F.col("rule").isNull()).collect()}
    assert verdicts == {open_[0][0]: "allow", open_[1][0]: "block"}


def test_scores_and_verdicts_by_hand(spark):
    rnd = random.Random(8)
    hosts = ["ab.net", "b.example.net", "example.com", "aab.org", "ba.info", "abba.info", "bab.info"]
    urls = [
        f"http://{rnd.choice(hosts)}/{rnd.choice(['en', 'de', 'fr'])}/{''.join(rnd.choices('ab', k=rnd.randint(0, 6)))}"
        for _ in range(150)
    ]
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(urls)], "page_id int, url string")
    marks = pages.select("page_id", u._letters(F.col("url")).alias("letters")).withColumn("fold", u._fold(F.col("letters")))
    by_id = {r.page_id: r for r in marks.collect()}
    rules = [ruled(*split(x)) for x in urls]

    def model(left_out):
        counts = {v: Counter() for v in ("allow", "block")}
        for i, r in enumerate(rules):
            if r and by_id[i].fold != left_out:
                w = by_id[i].letters
                counts[r.verdict].update(w[j : j + 4] for j in range(len(w) - 3))
        return counts

    def chance(counts, gram):
        prob = 1 / 39
        for order in range(4):
            follow = Counter()
            for g, n in counts.items():
                if g[3 - order : 3] == gram[3 - order : 3]:
                    follow[g[3]] += n
            total = sum(follow.values())
            if total:
                prob = (follow[gram[3]] + len(follow) * prob) / (total + len(follow))
        return prob

    def score(counts, w):
        grams = [w[j : j + 4] for j in range(len(w) - 3)]
        return sum(math.log(chance(counts["allow"], g) / chance(counts["block"], g)) for g in grams) / len(grams)

    models = {f: model(f) for f in range(u.FOLDS + 1)}
    scored = [(score(models[by_id[i].fold], by_id[i].letters), r.verdict, 1) for i, r in enumerate(rules) if r]
    bar = u._threshold(spark.createDataFrame(scored, "score double, verdict string, n bigint"))
    rows = [r for r in u.judge(pages).collect() if r.rule is None]
    assert len(rows) == sum(r is None for r in rules) > 20 and {r.verdict for r in rows} == {"allow", "block"}
    for r in rows:
        want = score(models[u.FOLDS], by_id[r.page_id].letters)
        assert abs(r.score - want) < 1e-9
        assert r.verdict == ("block" if want < bar else "allow")
