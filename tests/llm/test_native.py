import re
from collections import Counter

import pytest

from millrace.llm import licences, quality, urls
from tests.llm.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NOTICES = {
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "All rights reserved.": "all-rights-reserved",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
}


def measures(text):
    words = WORD.findall(text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(grams)
    covered = {k for i, g in enumerate(grams) if counts[g] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_op4_measures_and_order(spark, odd, odd_rows, empty, texts):
    more = [(100 + i, t) for i, t in enumerate(["a b c a b c x a b c", "x\n" * 60, "a a a a a a a", "one two three four two three four two three " * 12, "z " * 49, "#$ w " * 200])]
    from tests.llm.conftest import make

    docs = make(spark, [*odd_rows, *more, *texts])
    got = quality.judge(docs).select("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "rejected_by").collect()
    assert len(got) == len(odd_rows) + len(more) + len(texts)
    for r in got:
        m = measures(r.text)
        assert tuple(r)[2:7] == m, r.text[:80]
        if m[0] < 50 or 100 * m[4] > 50 * m[0]:
            assert r.rejected_by
    assert quality.judge(empty).count() == 0
    plain = {(r.doc_id, r.text): r.rejected_by is None for r in quality.judge(docs, ordered=False).collect()}
    assert plain == {(r.doc_id, r.text): r.rejected_by is None for r in got}


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_op6_equals_every_rule_on_every_url(spark, empty):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "https://a.b.net/es/1", "https://net/fr/", "https://xnet/fr/", "https://example.com/en", "https://example.com?/en/", "x://a://b/c", "https://u.org/banner/1", "https://u.org/a/login", "https://ads-track.e.org/1", "https://u.org/CASINO", "https://u.com/casino", "https://u.org/casinos", "https://m.mirror/list", "https://é.org/ß"]
    rows = [(i, u, *"xyzvw") for i, u in enumerate(odd)] + [(0, None, *"xyzvw"), (11, odd[11], *"xyzvw")]
    rows += [(r.page_id, r.url, *"hpvrw") for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, pattern string, rule string, verdict string")
    got = urls.filter_urls(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = host_path(r.url)
        assert (r.host, r.path) == (host, path)
        fits = [x for x in urls.HOST_RULES if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)]
        best = max(fits, key=lambda x: len(x.name), default=None)
        own = sorted(p.name for p in urls.PATTERNS if r.url and re.search(p.regex, r.url.lower()))
        assert r.rule == (best.name if best else None)
        assert r.pattern == (own[0] if own else None)
        assert r.verdict == (best.verdict if best else "block" if own else "allow")
    assert urls.filter_urls(pages.limit(0)).count() == 0
    with pytest.raises(ValueError):
        urls.rule_index(spark, pages.withColumnRenamed("url", "_mr_url"), (urls.Pattern("x", "y", ()),))


def test_literals_stand_in_what_the_patterns_match():
    for p in urls.PATTERNS:
        for url in ("https://ads-track.e.org/1", "http://a.ads-track.b/", "https://ad.doubleclick.net", "http://x/banner/", "http://x/pixel.gif", "http://x/login", "http://x/cart/", "http://casino", "http://x/warez", "http://x/mirror/list", "http://x?sessionid=1"):
            if re.search(p.regex, url):
                assert set(p.literals) <= set(re.split("[^a-z0-9]+", url))


def test_op1_finds_notices_and_nothing_else(spark, texts):
    got = {r.doc_id: r for r in licences.op1_licences(spark, SF).collect()}
    assert len(got) == len(texts)
    hits = 0
    for doc, text in texts:
        want = sorted({NOTICES[x] for x in (text or "").split("\n") if x in NOTICES})
        assert (got[doc].families or "") == ",".join(want)
        hits += bool(want)
    assert hits


def plain_scan(text, model):
    """Paragraph by paragraph: how many there are, the predicted ones that no template confirms, and the confirmed ones."""
    lines = [x for x in (text or "").split("\n") if re.search(r"[^ \t\n\x0b\f\r]", x)]
    suspect, found = 0, []
    for i, line in enumerate(lines):
        words = licences.words_of(line)
        if not set(words) & set(model.anchors):
            continue
        p = model.scores(words)
        family = model.classes[int(p.argmax())]
        if family == licences.UNKNOWN or p.max() < model.threshold:
            continue
        own = set(licences.shingles_of(words))
        similarity = max(len(own & set(t)) / min(len(own), len(t)) for t in map(licences.shingles_of, map(licences.words_of, licences.TEMPLATES[family])))
        if similarity >= 0.6:
            found.append((i, family, p.max(), similarity))
        else:
            suspect += 1
    return len(lines), suspect, found


def test_op1_equals_a_plain_scan_whatever_the_layout(spark, texts):
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    sample = licences.sample_paragraphs(docs, 60)
    assert sample and sample == licences.sample_paragraphs(docs.repartition(7), 60)
    model = licences.train(licences.sample_paragraphs(docs))
    own = [(900_000 + i, f"Some lines first.\n{t}\n\n{t[: len(t) // 2]}") for i, t in enumerate(t for ts in licences.TEMPLATES.values() for t in ts)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts + own, "doc_id long, text string"), model).collect()}
    some = 0
    for doc, text in texts + own:
        n, suspect, found = plain_scan(text, model)
        r = got[doc]
        assert (r.n_paragraphs, r.n_suspect, [(x.paragraph, x.family) for x in r.licences]) == (n, suspect, [f[:2] for f in found]), text
        for x, (_, _, p, s) in zip(r.licences, found, strict=True):
            assert abs(x.probability - p) < 1e-5 and abs(x.similarity - s) < 1e-5
        some += len(found)
    assert some > len(own)


def test_op4_skips_the_measures_of_rejected_documents(spark, odd, odd_rows):
    from tests.llm.conftest import make

    docs = make(spark, [(1, "two words"), (2, " ".join(f"word{i}" for i in range(80))), (3, "# " * 90)])
    rules = [*quality.base_rules(), *quality.default_rules()]
    r = {x.doc_id: x for x in quality.cascade(docs, rules).collect()}
    assert r[1].rejected_by == "few_words" and r[1].n_repeat_words is None and r[1].n_symbols is None and r[1].n_letters is None
    assert r[3].rejected_by == "repeats" and r[3].n_repeat_words == 90 and r[3].n_symbols is None
    assert r[2].rejected_by is None and r[2].n_letters == 320
    clash = docs.withColumnsRenamed({"lang": "n_words", "source": "rejected_by", "part": "n_letters"})
    kept = quality.keep(clash)
    assert kept.columns == clash.columns and [(x.doc_id, x.n_words, x.rejected_by, x.n_letters) for x in kept.collect()] == [(2, "x", "x", "x")]
    assert quality.keep(make(spark, [])).count() == 0


def test_op1_held_out_wordings_odd_rows_and_scores(spark, odd, odd_rows, empty):
    from tests.llm.conftest import make

    model = licences.train(["Some plain words stand here.", "Nothing about it at all."] * 20)
    held = {
        "Copyright (c) 2019 Jane Roe. All rights reserved.": "all-rights-reserved", "This code is released under the MIT License, see LICENSE.": "mit",
        "Licensed under the Apache License, Version 2.0, January 2004": "apache-2.0", "licensed under the gnu general public license, version 3 or newer": "gpl-3.0",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License, please.": "agpl", "Our work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License, too.": "cc-by-nc",
        "The general rights of the public were reserved for later.": None, "A license is needed to fish here.": None, "Version 2.0 of the file was modified.": None,
    }
    docs = make(spark, [*odd_rows, *[(100 + i, f"Before.\n{t}\nAfter.") for i, t in enumerate(held)]])
    got = licences.scan(docs, model).collect()
    assert len(got) == len(odd_rows) + len(held)
    by_id = {r.doc_id: r for r in got}
    for i, (text, family) in enumerate(held.items()):
        found = by_id[100 + i].licences
        assert [x.family for x in found] == ([family] if family else []), text
        for x in found:
            assert x.paragraph == 1 and abs(x.probability - model.scores(licences.words_of(text)).max()) < 1e-5
    assert all(not r.licences for r in got if r.doc_id is None or r.doc_id < 100)
    assert licences.scan(empty, model).count() == 0
