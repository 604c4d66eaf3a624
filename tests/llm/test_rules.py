"""Host-level rules and URL filters against plain-Python versions."""
import re
from collections import Counter, defaultdict
from itertools import combinations

import pytest

from estuary.llm import host_rules, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = defaultdict(list)
    for i in range(len(w) - 4):
        grams[tuple(w[i:i + 5])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    base = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return base, len(w) < 10 or 100 * len(covered) > 20 * len(w)


def plain_host_verdicts(rows, limit):
    by = defaultdict(list)
    for host, failed in rows:
        by[host].append(failed)
    n = sum(map(len, by.values()))
    m = sum(map(sum, by.values())) / n
    noise = m * (1 - m)
    spread = sum(len(v) * (sum(v) / len(v)) ** 2 for v in by.values()) / n - m * m - noise * len(by) / n
    s = host_rules.MAX_STRENGTH if spread * host_rules.MAX_STRENGTH <= noise else max(noise / spread - 1, 1.0)
    return {h: (sum(v) + m * s) / (len(v) + s) <= limit for h, v in by.items()}


def test_host_rules_match_plain_python(docs_of, odd_rows):
    rows = odd_rows + [(200 + i, "one two three four five six seven eight nine ten " * 2 + str(i), "bad") for i in range(30)]
    rows += [(300, "a b c d e\n a b c d e x a b c d e y z\n\n a b c d e\n#*$%&|<>", "s1"), (301, "q " * 3000, "s2")]
    rows += [(400 + i, " ".join(f"{i}w{k}" for k in range(20)), "bad") for i in range(5)]
    out = host_rules.judge_documents(docs_of(rows)).collect()
    counts = [(i, s, *plain_counts(t)) for i, t, s in rows]
    hosts = plain_host_verdicts([(s, f) for _, s, _, f in counts], host_rules.HOST_LIMIT)
    assert hosts["bad"] is False and hosts["hot"] is True
    want = Counter((i, s, *c, f, not f and hosts[s]) for i, s, c, f in counts)
    assert Counter((r.doc_id, r.source, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                    r.base_failed, r.kept) for r in out) == want
    assert host_rules.judge_documents(docs_of([])).collect() == []


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1?x=1#f", "https://example.org/es", "a://b://c/d",
    "https://notexample.org/es/1", "https://com/fr/x", "https://x.com/fr/", "https://x.com/de/a.html", "ftp://É.COM/de/1",
    "https://example.org/en/1", "https://example.org/en/2", "https://shop-win.net/es/1?utm=1&&ref=2#top", "https://x.net?a/b",
    "http://x.com/fr/?q#", "http://x.com#/fr/",
]


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), v, h + p) for v, h, p in url_rules.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


def pages_df(spark, urls):
    return spark.createDataFrame([(i, u, "<p>", "t", "v") for i, u in enumerate(urls)],
                                 "page_id bigint, url string, html string, tokens string, verdict string")


def test_url_parts_and_explicit_rules(spark):
    out = {r.page_id: r for r in url_rules.judge_urls(pages_df(spark, URLS)).collect()}
    assert len(out) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = plain_url(u)
        verdict, rule = plain_rule(host, path)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), u
        assert out[i].verdict in ("allow", "block") and (verdict is None or out[i].verdict == verdict)
    assert url_rules.judge_urls(pages_df(spark, [])).collect() == []
    assert [r.verdict for r in url_rules.judge_urls(pages_df(spark, [None, "https://x.net/"])).collect()] == ["allow"] * 2


def test_tokens_of_every_part(spark):
    cases = {
        "https://shop-win.a.net/de/12/x.y/7.html?utm=feed&page=3&&flag&=v#t":
            {"h:shop-win", "h:a", "h:net", "w:shop", "w:win", "d:de", "d:#", "d:x.y", "p:#", "x:html", "q:utm", "q:page", "q:flag",
             "v:utm=feed", "v:page=#", "f:"},
        "http://a/b/b/": {"h:a", "d:b"}, "http://a/b": {"h:a", "p:b"}, "http://a": {"h:a"}, "none": set(), None: set(),
        "http://a/.x/9a.GZ": {"h:a", "d:.x", "p:9a", "x:gz"},
        "http://a/" + "deep/" * 3000 + "z" * 5000: {"h:a", "d:deep", "p:" + "z" * 5000},
    }
    df = pages_df(spark, list(cases))
    parts = url_rules.url_parts(df["url"])
    out = df.select("page_id", url_rules.url_tokens(*parts.values()).alias("t")).collect()
    for r in out:
        want = list(cases.values())[r.page_id]
        assert set(r.t) == want and len(r.t) == len(want)


def test_a_deep_segment_decides_and_repeated_rows_stay(spark):
    """The telling token stands deep in the path or in a query value; long URLs and copies are kept."""
    urls = [f"https://h{i}.example.org/en/{'1' if i % 2 else '2'}/k/{'bad' if i % 2 else 'good'}/p?s={'spam' if i % 2 else 'ok'}"
            for i in range(40)]
    ask = ["https://q.net/x/y/bad/z", "https://q.net/x/y/good/z", "https://q.net/?s=spam", "https://q.net/" + "long/" * 2000 + "bad/"]
    out = url_rules.judge_urls(pages_df(spark, urls + ask * 2)).orderBy("page_id").collect()
    assert [r.verdict for r in out[40:]] == ["block", "allow", "block", "block"] * 2
    assert all(r.rule is None for r in out[40:])


def test_mining_and_matching_match_brute_force(spark):
    sets = [(("a", "b", "hot"), "block"), (("a", "c", "hot"), "block"), (("b", "c"), "allow"), (("a", "b", "c"), "block"),
            (("c", "d", "hot"), "allow"), (("d",), "allow"), (("b", "d", "hot"), "allow"), (("a", "d"), "block"), ((), "allow")] * 7
    labelled = spark.createDataFrame([(list(t), v) for t, v in sets], "tokens array<string>, verdict string")
    rules = {}
    total = Counter()
    for t, v in sets:
        for k in range(1, len(t) + 1):
            for c in combinations(t, k):
                total[c] += 1
                rules[c, v] = rules.get((c, v), 0) + 1
    rules = {(c, v): (n / total[c], n / len(sets)) for (c, v), n in rules.items()
             if n >= 0.1 * len(sets) and n / total[c] >= 0.6}
    kept = {(c, v): x for (c, v), x in rules.items()
            if not any(v2 == v and set(c2) < set(c) and x2[0] >= x[0] for (c2, v2), x2 in rules.items())}
    mined = url_rules.mine(labelled, 0.1, 0.6)
    got = {(tuple(r.antecedent), r.verdict): (r.confidence, r.support) for r in mined.collect()}
    assert got.keys() == kept.keys() and all(got[k] == pytest.approx(kept[k]) for k in kept)
    ask = [["a"], ["b", "d"], ["x"], ["a", "c", "z"], ["b", "hot"], []]
    found = {tuple(r.tokens): r.verdict for r in url_rules.match(
        spark.createDataFrame([(t,) for t in ask], "tokens array<string>"), mined).collect()}
    for t in ask:
        fits = [(x, v == "allow", v) for (c, v), x in kept.items() if set(c) <= set(t)]
        assert found.get(tuple(t)) == max(fits, default=(0, 0, None))[2]
