"""URL rules, license scan and fixity audit."""

from __future__ import annotations

import re

import pytest

from chartfold.llm import fixity, license_scan, url_rules
from oracle import compare, connect


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(url):
    host, path = parts(url)
    fits = []
    for rule in url_rules.RULES:
        name, rest = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/1", "https://example.net/en", "https://a.net?x=/en/",
        "https://a.net/", "x://example.com/de/#f", "x://example.com/DE/", "x://b.example.com/de/3?q=1&r=2", "x://notexample.com/de/",
        "x://fr.org/fr/", "x://org/fr/z", "x://a.org/fr", "x://ÉCOLE.org/fr/ü", "x://a.b/c\nd/e", "x://y://example.net/en/"]


def test_base_rules_and_every_row(spark):
    urls = [*URLS, *URLS[4:7], *[f"https://h{i % 7}.net/de/{i}" for i in range(60)]]
    pages = spark.createDataFrame([(i, u, "x", "clash") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string")
    made = {r.page_id: r for r in url_rules.filter_urls(pages).collect()}
    assert len(made) == len(urls)
    for i, url in enumerate(urls):
        assert (made[i].host, made[i].path) == parts(url), url
        assert made[i].rule == rule_of(url), url
        if made[i].rule:
            assert made[i].verdict == url_rules.RULES[made[i].rule]


def test_mined_rules_equal_brute_force(spark):
    urls = [f"https://{h}.{t}/{p}/{i}" for i in range(12) for h in ("ads", "news") for t in ("net", "com", "org")
            for p in ("de", "fr")]
    given = {"net/": "block", "ads.com/": "block", "news.com/": "allow"}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    made = url_rules.filter_urls(pages, given, min_support=0.05, min_confidence=0.9).collect()
    free = {r.host: (r.verdict, r.mined_rule) for r in made if r.rule is None}
    # ads on .net and .com are always blocked; news are blocked on .net and allowed on .com.
    assert free["ads.org"][0] == "block" and "host=ads" in free["ads.org"][1]
    assert free["news.org"] == ("allow", None)


def test_any_token_of_those_that_go_together_meets_their_rule(spark):
    """aa and bb lie in the same labelled urls; other urls hold one of them, or both."""
    urls = [f"https://x{i % 3}.net/aa/bb/{i}" for i in range(30)] + [f"https://y.com/cc/{i}" for i in range(30)]
    free = ["https://z.org/aa", "https://z.org/bb", "https://z.org/bb/aa", "https://z.org/dd"]
    pages = spark.createDataFrame(list(enumerate(urls + free)), "page_id long, url string")
    given = {"net/": "block", "com/": "allow"}
    made = {r.page_id - len(urls): (r.verdict, r.mined_rule) for r in url_rules.filter_urls(pages, given).collect()
            if r.page_id >= len(urls)}
    assert made == {0: ("block", "path=aa"), 1: ("block", "path=bb"), 2: ("block", "path=aa path=bb"), 3: ("allow", None)}


def test_long_urls_that_repeat_do_not_explode(spark):
    long = "https://a.net/" + "/".join(f"p{c}" for c in "abcdefghijklmnopqrstuvwxyzäöü")
    pages = spark.createDataFrame([(i, long) for i in range(40)] + [(99, "x://b.com/pa/pb")], "page_id long, url string")
    assert url_rules.filter_urls(pages).count() == 41


def test_no_labels_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "x://b.com/pa"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in url_rules.filter_urls(pages).collect()} == {"allow"}
    assert url_rules.filter_urls(pages.limit(0)).count() == 0


def phrases_in(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, label) for phrase, label in license_scan.PHRASES.items()
             for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), found


LICENSED = ["Released under the MIT License.", "mit   license, MIT-LICENSE", "CC BY CC BY cc cc by", "gnu general public",
            "GNU General Public License", "apache\nLICENSE apache", "mit", "mit licensé", "the K license", None, "", "...",
            "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and "
            "associated documentation files (the Software), to deal in the Software without restriction",
            "permission is granted to any person of this and that " * 30]


def test_phrases_equal_brute_force(spark, corpus, tmp_path):
    rows = [(i, t) for i, t in enumerate(LICENSED)] + [(0, LICENSED[0]), (0, LICENSED[2]), (None, LICENSED[0])]
    corpus(rows).write.parquet(f"{tmp_path}/documents.parquet")
    made = license_scan.op6_license_scan(spark, str(tmp_path)).collect()
    expected = []
    for doc, text in rows:
        n, found = phrases_in(text)
        at = sorted(i for i, _ in found)
        expected.append((doc, n, len(found), at[0] if at else None, at[-1] if at else None,
                         ",".join(sorted({label for _, label in found}))))
    assert sorted((tuple(r)[:6] for r in made), key=str) == sorted(expected, key=str)
    for r in made:
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1


def test_template_with_an_added_word_is_found(spark, corpus):
    found = license_scan.scan(corpus([(0, "so. " + LICENSED[12]), (1, LICENSED[13])])).where("NOT exact").collect()
    spans = {(r.doc_id, r.template): (r.start, r.end) for r in found if r.template}
    assert spans == {(0, "mit-notice"): (1, 31)}


def test_empty_documents(spark, corpus):
    assert license_scan.scan(corpus([])).count() == 0


def test_audit_equals_sql(spark):
    assert compare(fixity.op4_merkle_audit(spark, "/root/testdata/sf0.001"), fixity.ORACLE, connect("/root/testdata/sf0.001")) > 0


@pytest.mark.parametrize("span, fanout", [(8, 2), (64, 4), (1 << 18, 16)])
def test_audit_finds_every_difference(spark, span, fanout):
    rows = [(a, 10 * i, 10, f"d{a}{i}") for a in range(3) for i in range(25)]
    left = spark.createDataFrame(rows, "archive long, offset long, length long, digest string")
    changed = [(a, o, n, "bad" if o == 70 else d) for a, o, n, d in rows if (a, o) != (1, 30)] + [(2, 255, 5, "new"), (9, 0, 1, "z")]
    found = fixity.audit(left, spark.createDataFrame(changed, left.schema), span, fanout).collect()
    assert {tuple(r) for r in found} == {(0, 70, "corrupt"), (1, 70, "corrupt"), (2, 70, "corrupt"), (1, 30, "missing"),
                                         (2, 255, "extra"), (9, 0, "extra")}
    assert fixity.audit(left, left, span, fanout).count() == 0
    assert fixity.audit(left.limit(0), left.limit(0), span, fanout).count() == 0


def test_odd_pages(spark):
    pages = spark.createDataFrame([(None, None, None), (1, "u", ""), (1, "u", ""), (2, "ü", "é")],
                                  "page_id long, url string, html string")
    assert fixity.page_archives(pages).count() == 4


def test_offsets_of_a_large_archive_are_made_in_ranges(spark, monkeypatch):
    """A third of the pages without id, a third of one id, copies among both."""
    monkeypatch.setattr(fixity, "RANGE_ROWS", 20)
    ids = [None] * 100 + [7] * 100 + list(range(900, 1100))
    pages = spark.createDataFrame([(p, f"u{i % 40}", "h" * (i % 30)) for i, p in enumerate(ids)],
                                  "page_id long, url string, html string")
    made = fixity.page_archives(pages)
    assert "offset" in made.columns
    rows, ends = made.orderBy("archive", "offset").collect(), {}
    assert len(rows) == 400
    for a, b in zip([None, *rows], rows):
        assert b.offset == ends.get(b.archive, 0)
        ends[b.archive] = b.offset + b.length
        if a and a.archive == b.archive:
            assert ((a.page_id or -1), a.digest) <= ((b.page_id or -1), b.digest)
    windows = [w for w in made._jdf.queryExecution().toString().split("\n") if "windowspecdefinition(archive" in w]
    assert windows and all("range" in w for w in windows)
