"""Main text of pages, archives read back, licences and the pipeline."""

import hashlib

from sluice.llm import warc as W
from sluice.llm.html_extract import extract_text, host_of, page_text
from sluice.llm.license_rules import CORES, HINT, NAMES, RULES, SENTENCES, expand, licenses_of, scan, tries


def text_of(page):
    return page_text(page)


def test_blocks_of_pages():
    cases = {
        "": "", "just text": "just text", "<p>a &amp; b&nbsp;c<p>d": "a & b c\n\nd", "<article><h1>T</h1><p><b>x.<br><p>y</article><footer>f</footer>": "T\n\nx.\n\ny",
        "<body><nav><ul><li>m</ul></nav><p>one<script>var a='</p>'</script> two</p></body>": "one two", "<p>cut off &am": "cut off &am",
        "<article>a<div class='cookie-notice'>c</div>b<section id=comments><p>r</p></section><form>f</form></article>": "a\n\nb",
        "<!-- <p>no --><p title=\"a>b\">yes</p><!-- open <p>x": "yes", "<ul><li>a<li>b</ul>": "a\n\nb", "<p>a</b>b</p></div>c": "ab\n\nc",
        "<style>p{}</style><textarea><p>x</textarea>t": "t", "<main><p>main</p></main><aside>s</aside><p>out": "main", "<table><tr><td>1<td>2<tr><td>3</table>": "1\n\n2\n\n3",
        "<article>short</article><article>the longer one</article>": "short\n\nthe longer one", "a <span>b</span>c\n\n d": "a bc d", "<p>a<b>b</p><p>c": "ab\n\nc",
    }
    for page, want in cases.items():
        assert text_of(page) == want, page


def test_deep_and_broken_pages_end():
    assert text_of("<div>" * 5000 + "x" + "</div>" * 100) == "x"
    assert text_of("<a href='" * 3000) == "" and text_of("<" * 5000 + "p") .startswith("<")


def test_time_and_memory_are_linear_in_a_page_of_any_depth():
    import time
    import tracemalloc

    n = 200_000
    for page, size in (("<div>x" * n, 3 * n - 2), ("<section>" * (n // 2) + "</i>" * n + "x", 1), ("<i><div>" + "<b>" * n + "</i>" * n, 0),
                       ("<div>" + "<b>" * n + "<hr>x" * n, 3 * n - 2), ("<article>x" * n, 3 * n - 2), ("<h2>Comments</h2><p>x" * n, 0),
                       ("<div><time>1:00</time>x" * n, 7 * n - 2)):
        began = time.thread_time()
        assert len(text_of(page)) == size, page[:40]
        assert time.thread_time() - began < 30
    tracemalloc.start()
    text_of("<div>x" * n)
    assert tracemalloc.get_traced_memory()[1] < 500 << 20
    tracemalloc.stop()


def test_wrappers_never_hide_the_main_content():
    cases = {
        '<form id="aspnetForm"><div><article><p>a</p></article></div></form>': "a", "<form><div class=menu>m</div><p>a page in a form</p></form>": "a page in a form",
        "<header><main>a</main></header>": "a", "<div role=dialog><article>a</article></div>": "a", "<article>a<aside><article>b</article></aside></article>": "a",
        "<div>the long body of the page</div><aside><article>related</article></aside>": "the long body of the page",
        "<p>the page text</p><form><input><label>Name</label></form>": "the page text", "<p>a <button>Click</button> b <svg><text>s</text></svg>c</p>": "a b c",
    }
    for page, want in cases.items():
        assert text_of(page) == want, page


def test_classes_mark_by_their_head_word():
    gone = ("left-sidebar related-posts ad-container google-ads adsbygoogle cookie-law-info top-nav-wrap user-comments fb-comments "
            "commentlist sidebar sidebar-left footer-links social-share-buttons newsletter-signup comment-list").split()
    kept = "has-sidebar with-menu comments-open sidebar-layout post entry-content no-ads story-share-price-report social-science menu-recipes main-content".split()
    for name in gone:
        assert text_of(f"<p>the text</p><div class='x1 {name}'><p>gone</p></div>") == "the text", name
        assert text_of(f"<article><p>the text</p><div id='{name}'><p>gone</p></div></article>") == "the text", name
    for name in kept:
        assert text_of(f"<p>the</p><div class='{name}'><p>text</p></div>") == "the\n\ntext", name


def test_reader_comments_go_by_structure():
    body = "<p>" + "the article says many things " * 20 + "</p>"
    text = ("the article says many things " * 20).strip()
    item = "<li><b>Name {i}</b><p>May {i}, 2021</p><p>I do not agree with this, number {i}</p></li>"
    items = "".join(item.format(i=i) for i in range(4))
    timed = "".join(f"<div><div>Ann {i}</div><time>yesterday</time><p>so true {i}</p></div>" for i in range(3))
    for page in (f"<article>{body}<ul>{items}</ul></article>", f"<main>{body}{timed}</main>", f"{body}<div>{timed}</div>",
                 f"{body}<div><h3>3 Comments</h3><p>first!</p></div>", f"<article>{body}<h2>Leave a reply</h2><p>Your name</p></article>",
                 f"{body}<section><h4>Kommentare (2)</h4><div>a</div></section>", f"{body}<div itemprop=comment><p>x</p></div>",
                 f"{body}<div itemscope itemtype='https://schema.org/Comment'><p>x</p></div>"):
        assert text_of(page) == text, page[-80:]
    posts = "".join(f"<div><h2>Post {i}</h2><time>2021</time><p>{'words of a post ' * 9}</p></div>" for i in range(4))
    assert text_of(f"<p>My blog</p>{posts}").count("words of a post") == 36  # a list of posts is the page's text
    assert "Comments on a law" in text_of(f"{body}<h2>Comments on a law</h2><p>more</p>")


def test_query_reads_the_given_pages_as_a_plain_reading_does(spark, sf):
    """The generated pages: one article with its title and paragraphs; everything else is boilerplate."""
    import html as H
    import re

    from sluice.llm import queries

    got = {r.page_id: r for r in queries.queries()["op1_html_extract"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = re.split(r"</?(?:p|h\d|div|ul|ol|li|table|tr|td|blockquote|pre|section)\b[^>]*>", re.sub(r"<br[^>]*>", " ", inner))
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in parts]
        want = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (want, len(want), p.url), p.page_id


def test_classes_never_drop_the_article():
    cases = {
        "<article class='post comments-open'><p>a</p></article>": "a", "<div class='layout has-sidebar'><p>a</p></div>": "a",
        "<div id='page' class='with-menu'><p>a</p></div>": "a", "<div class='menu sidebar'><div><article><p>a</p></article></div></div>": "a",
        "<article class=notice><p>a</p></article>": "a", "<div class=sidebar><main><p>a</p></main></div>": "a",
        "<main><div class=sidebar><article>a</article></div></main>": "a", "<div class=layout><div class=modal><article>long enough</article></div><div class=sidebar><article>b</article></div></div>": "long enough",
        "<main><article>a<section id=comments><article>c</article></section></article></main>": "a", "<p>a</p><div class=comment-list><article>c, and longer</article></div>": "a",
        "<article>a</article><article class='comment depth-1'>c, and longer</article>": "a", "<div class='site-footer'>f</div><ul id=main-nav><li>n</ul><div class='ad-1 x'>s</div><p>a": "a",
    }
    for page, want in cases.items():
        assert text_of(page) == want, page


def test_templates_go_by_their_recurrence_on_a_host(spark):
    box = "<div><p>Read more of our site</p></div>"
    rows = [(i, f"http://user@A.com:80/{i}", f"<article><h1>Title {i}</h1><p>own {i}</p><p>Said on every page.</p>{box}</article>") for i in range(8)]
    rows += [(100 + i, "http://b.com/x", f"<h2>Head {i}</h2>{box}<p>text {i}</p>") for i in range(8)]
    rows += [(200 + i, "http://c.com/x", f"<h2>Same</h2>{box}<p>copied page</p>") for i in range(8)]
    rows += [(300, None, box), (301, "http://few.com/", box), (302, "http://few.com/", None), (303, "http://few.com/", "")]
    df = spark.createDataFrame([(*r, "w") for r in rows], "page_id int, url string, html string, blocks string").repartition(3)
    got = {r.page_id: r.text for r in extract_text(df).collect()}
    assert got[0] == "Title 0\n\nown 0\n\nSaid on every page." and got[103] == "Head 3\n\ntext 3"
    assert got[200] == "Same\n\nRead more of our site\n\ncopied page"  # copies of one page are no recurrence
    assert got[300] == got[301] == "Read more of our site" and got[302] == got[303] == ""
    assert {r.h for r in df.select(host_of("url").alias("h")).collect()} == {"a.com", "b.com", "c.com", "few.com", None}
    assert extract_text(df.limit(0)).count() == 0


def test_all_articles_stay_and_a_teaser_is_not_the_page(spark):
    promo = "<article><p>Subscribe to us today</p></article>"
    rows = [(1, "http://a.com/", "<article>short</article><div>date</div><article>the longer one</article><article class=comment>me too</article>"),
            (2, "http://a.com/", "<article>teaser</article><div>The body of the page, in a box of its own.</div>"),
            (3, "http://a.com/", "<article>the only one, most of the text</article><p>related</p>"),
            (4, "http://a.com/", "<p>whole page</p>"), (5, "http://a.com/", "<article></article><p>beside nothing</p>")]
    rows += [(10 + i, "http://b.com/", f"<article><p>own text {i}</p></article>{promo}") for i in range(6)]
    rows += [(20, "http://b.com/", promo), (21, "http://b.com/", promo + promo)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[1] == "short\n\nthe longer one" and got[2] == "teaser\n\nThe body of the page, in a box of its own."
    assert got[3] == "the only one, most of the text" and got[4] == "whole page" and got[5] == "beside nothing"
    assert got[12] == "own text 2" and got[20] == "Subscribe to us today" and got[21] == "\n\n".join(["Subscribe to us today"] * 2)


def test_templates_go_where_the_heading_is_template_itself(spark):
    logo, skip, more = "<div class=title><h1>The Site</h1></div>", "<div>Skip to content</div>", "<div><p>More of our site</p></div>"
    rows = [(i, "http://a.com/", f"{logo}<p>text {i}</p>{more}") for i in range(8)]
    rows += [(100 + i, "http://b.com/", f"{skip}<p>text {i}</p>{more}") for i in range(8)]
    rows += [(200 + i, "http://c.com/", f"{logo}<p>one text</p>{more}") for i in range(8)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()}
    assert got[3] == got[103] == "text 3" and got[200] == "The Site\n\none text\n\nMore of our site"


def test_url_keys():
    for url, key in {None: "", "": "", "https://Www.A.b.com/x?y#z": "com,b,a,www)/x?y", "http://a.com:80": "com,a)/", "http://a.com:81/": "com,a:81)/",
                     "no host": "no%20host", "http://[bad/": "http://[bad/", "http://a.com/ b\n": "com,a)/%20b%0A"}.items():
        assert W.surt(url) == key == W.surt(W.clean_uri(url) if url else url)


def test_archives_round_trip(spark):
    rows = [(i, f"http://s{i % 7}.example.com/{i // 3}", f"<p>{'x' * 40 * (i % 50)} {i % 20}</p>") for i in range(300)]
    rows += [(1000, None, None), (1001, "", ""), (1002, "http://x.y/ z\n", "é" * 600), (1003, "q", "é" * 600), (None, "n", "é" * 600), (1004, "t\tab", "a" * 999), (1005, "t\tab", "a" * 999)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    out = W.archive_round_trip(spark, df, block_lines=7).collect()
    assert len(out) == len(rows)
    top = {}
    for i, _, h in rows:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    for r in out:
        i = int(r.page) if r.page else None
        h = next(x[2] for x in rows if x[0] == i) or ""
        revisit = len(h.encode()) >= 1000 and top[h] != i
        assert (r.payload_bytes, r.payload_digest) == (len(h.encode()), hashlib.sha1(h.encode()).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", str(top[h])) if revisit else ("response", None))
    assert W.archive_round_trip(spark, df.limit(0)).count() == 0


def test_archives_are_valid_and_lookups_find_single_keys(spark):
    df = spark.createDataFrame([(i, f"http://a.com/{i % 40}", "x" * i) for i in range(200)], "page_id long, url string, html string")
    manifest = W.write_archives(df)
    for m in manifest.collect():
        found = [W.parse_record(d) for _, _, d in W._read_members(m.file)]
        assert len(found) == m.records
        for headers, block in found:
            assert len(block) == int(headers["content-length"]) and headers["warc-type"] == "response" and block.startswith(b"HTTP/1.1 200 OK")
    parts = W.build_index(manifest, block_lines=3)
    index = W.Lookup([tuple(r) for r in parts.collect()])
    assert sorted(int(x[1]) for x in index.find("com,a)/7")) == [7, 47, 87, 127, 167] and not list(index.find("com,a)/99")) and not list(index.find(""))
    some = W.read_records(W.look_up(parts, df.where("page_id in (5, 199)"))).collect()
    assert sorted((r.page, bytes(r.payload)) for r in some) == [("199", b"x" * 199), ("5", b"x" * 5)]


def test_a_lookup_opens_few_blocks_of_a_url_with_most_rows(spark, monkeypatch):
    rows = [(i, None if i % 3 else f"http://a.com/{'é' if i % 2 else '𐐀'}", f"<p>{i}</p>") for i in range(400)]
    rows += [(7, None, "again"), (7, None, "and again")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    parts = W.build_index(W.write_archives(df), block_lines=4)
    top = [tuple(r) for r in parts.collect()]
    index, read = W.Lookup(top), []
    monkeypatch.setattr(W, "read_range", lambda *a, f=W.read_range: read.append(a) or f(*a))
    for page in (7, 20, 398):
        read.clear()
        assert [x[1] for x in index.find("", str(page))] == [str(page)] * (3 if page == 7 else 1) and len(read) <= 4
    assert not list(index.find("", "401x")) and len(list(index.find(""))) == sum(r[1] is None for r in rows)
    found = W.look_up(parts, df).groupBy("page").count().collect()
    assert {int(r.page): r["count"] for r in found} == {i: 3 if i == 7 else 1 for i in range(400)}


def test_hot_digests_and_boxes_are_joined_apart(spark, monkeypatch):
    from functools import partial

    from sluice.llm import common
    from sluice.llm import html_extract as H

    hot, saved = [], common.save
    monkeypatch.setattr(common, "save", lambda df, name: hot.append((name, df.count())) or saved(df, name))
    rows = [(i, f"http://a.com/{i}", ("é" * 600 if i % 3 else f"{i // 9}" * 1200) if i % 2 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(str, W.archive_round_trip(spark, df).collect()))
    assert not hot
    monkeypatch.setattr(W, "MAX_BROADCAST_DIGESTS", 0)
    monkeypatch.setattr(W, "join_one", partial(common.join_one, hot_rows=5))
    assert sorted(map(str, W.archive_round_trip(spark, df).collect())) == want
    assert [x for x in hot if x[0] == "hot-keys"] == [("hot-keys", 2), ("hot-keys", 1)]  # the empty and the common page; revisits to the latter
    hot.clear()
    monkeypatch.setattr(H, "join_one", partial(common.join_one, hot_rows=5))
    pages = [(i, None if i % 2 else "http://a.com/", f"<div>menu</div><p>text {i}</p>") for i in range(20)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(pages, "page_id int, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(20)} and ("hot-keys", 2) in hot


MIT = '''/*
 * The MIT License (MIT)
 *
 * Copyright (c) 2020 Someone
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software.
 *
 * THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 * IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
 * FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
 * AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
 * LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
 * OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
 * SOFTWARE.
 */'''


def test_license_sentences_and_rules(spark):
    cases = {
        MIT: [("MIT", 1), ("MIT", 4)], "x\nReleased under the MIT License. More prose.": [("MIT", 1)], "junk |\nLicensed under CC BY-NC 4.0.\nAll rights reserved.": [("CC-BY-NC-4.0", 1), ("All-Rights-Reserved", 1)],
        "This work is licensed under the GNU General Public License, version 3.": [("GPL-3", 1)], "The license of prose is no license. Permission is a word.": [],
        "Licensed under the Apache License, Version 2.0. one. two. You may not use this file except in compliance with the License.": [("Apache-2.0", 2)],
        "Licensed under the Apache License, Version 2.0. one. two. three. You may not use this file except in compliance with the License.": [("Apache-2.0", 1)],
        "": [], None: [], "MIT License\n\n" + "filler text. " * 3000 + "\nLicensed under CC0 1.0.": [("MIT", 1), ("CC0-1.0", 1)],
    }
    df = spark.createDataFrame([(i, t, "was") for i, t in enumerate(cases)], "i int, text string, licenses string")
    got = {r.i: [(x.license, len(x.sentences)) for x in r.licenses] for r in scan(df).collect()}
    assert got == dict(enumerate(cases.values()))
    assert scan(df.limit(0)).count() == 0


def filled(words, name="mit license"):
    """A template's words with its slots filled."""
    fill = {"#": "2.0", "<url>": "https://example.org/x", "<name>": name, "<spdx>": "MIT OR Apache-2.0"}
    return " ".join(fill.get(w, "acme labs" if w[0] == "<" else w) for w in words)


def test_license_tables_are_consistent():
    import re

    assert all(i in SENTENCES for _, rule, _ in RULES for i in rule) and set(SENTENCES) == {i for _, rule, _ in RULES for i in rule}
    for k, (_, rule, closed) in enumerate(RULES):  # a rule stands before a longer one that starts with it only if it is closed
        assert closed or not any(longer[: len(rule)] == rule and len(longer) > len(rule) for _, longer, _ in RULES[k + 1:])
    for known in SENTENCES.values():
        for t in known:
            assert all(re.search(HINT, filled(w), re.IGNORECASE) and any(c in filled(w) for c in CORES) for w in expand(t)), t
    owner = {}
    for name, forms in NAMES.items():
        for words in (tuple(w) for f in forms for w in expand(f)):
            assert owner.setdefault(words, name) == name or name == "BSD-2-Clause", words
    assert expand("a? (b|c) d") == [["b", "d"], ["c", "d"], ["a", "b", "d"], ["a", "c", "d"]] and tries()[0]["all"]["rights"]["reserved"]


GPL3 = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with this program.  If not, see <https://www.gnu.org/licenses/>."""
GPL2 = """/* This program is free software; you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation; either version 2 of the License, or
 * (at your option) any later version. */"""
MPL2 = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"""
APACHE = """// Licensed under the Apache License, Version 2.0 (the "License");
// you may not use this file except in compliance with the License.
// You may obtain a copy of the License at
//
//     http://www.apache.org/licenses/LICENSE-2.0
//
// Unless required by applicable law or agreed to in writing, software
// distributed under the License is distributed on an "AS IS" BASIS,
// WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
// See the License for the specific language governing permissions and
// limitations under the License."""


def test_license_headers_and_wraps(spark):
    wrapped = MIT.replace("portions of the Software", "portions of the\n * Software").replace("FOR A PARTICULAR", "FOR A\n * PARTICULAR")
    cases = {GPL3: [("GPL-3-or-later", 6)], GPL2: [("GPL-2-or-later", 2)], MPL2: [("MPL-2.0", 2)], MPL2.replace("v. 2.0", "v.\n * 2.0"): [("MPL-2.0", 2)],
             APACHE: [("Apache-2.0", 5)], wrapped: [("MIT", 1), ("MIT", 4)], "MIT License\n2020 Someone\nAll rights\nReserved": [("MIT", 1), ("All-Rights-Reserved", 1)]}
    df = spark.createDataFrame(list(enumerate(cases)), "i int, text string")
    got = {r.i: [(x.license, len(x.sentences)) for x in r.licenses] for r in scan(df).collect()}
    assert got == dict(enumerate(cases.values()))


def test_every_license_sentence_and_rule_is_found():
    for name, ids, _ in RULES:
        notice = "apache license version 2.0" if name.startswith("Apache") else "mit license"
        for k, i in enumerate(ids):
            for words in (w for t in SENTENCES[i] for w in expand(t)):  # each known form at its place, plain, then every word in capitals on its own line
                said = [filled(words if n == k else expand(SENTENCES[j][0])[0], notice) + "." for n, j in enumerate(ids)]
                for text in (" ".join(said), "\n".join(w[0].upper() + w[1:] for x in said for w in x.split()).replace("\n-\n", " -\n")):
                    got = licenses_of(text)
                    assert [x["sentences"] for x in got] == [list(ids)], (text, got)
                    assert name in ("*", "BSD-Other") or got[0]["license"] == name.replace("#", "2.0"), (text, got)


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
{more}
THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS ``AS IS'' AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE
ARE DISCLAIMED."""
THIRD = """3. Neither the name of the {holder} nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission."""
FOURTH = """3. All advertising materials mentioning features or use of this software
   must display the following acknowledgement:
   This product includes software developed by the University of
   California, Berkeley and its contributors.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty.  In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not
   claim that you wrote the original software. If you use this software
   in a product, an acknowledgment in the product documentation would be
   appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be
   misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""


def test_bsd_texts_by_their_clauses():
    for holder in ("University", "copyright holder", "Acme Software Company of Springfield, Inc."):
        assert [x["license"] for x in licenses_of(BSD.format(more=THIRD.format(holder=holder)))] == ["BSD-3-Clause"], holder
    assert [x["license"] for x in licenses_of(BSD.format(more=""))] == ["BSD-2-Clause"]
    assert [x["license"] for x in licenses_of(BSD.format(more=FOURTH + THIRD.format(holder="University").replace("3.", "4.")))] == ["BSD-4-Clause"]
    # An unknown clause where the third would stand makes it another licence.
    for odd in ("3. You must send the author a postcard.", "   * Do not use this on Sundays.", "The name of nobody may appear anywhere at all."):
        assert [x["license"] for x in licenses_of(BSD.format(more=odd))] == ["BSD-Other"], odd


def test_common_notices_and_texts():
    cases = {
        "This software is licensed under the Apache License, Version 2.0.": "Apache-2.0", "Code is licensed under the MIT License.": "MIT",
        "This article is licensed under a Creative Commons Attribution 4.0 International License.": "CC-BY-4.0",
        "// SPDX-License-Identifier: Apache-2.0 OR MIT\nint x;": "Apache-2.0 OR MIT", "# SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0-only",
        "Released under the GPLv3 license.": "GPL-3", "This is available under the GNU GPL version 2 or later.": "GPL-2-or-later",
        "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file LICENSE_1_0.txt or copy at\nhttp://www.boost.org/LICENSE_1_0.txt)": "BSL-1.0",
        "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
        GPL2.replace("the GNU General Public License as published by\n * the Free Software Foundation; either version 2 of the License, or\n * (at your option) any later version.",
                     "the GNU General Public License version 2 as\n * published by the Free Software Foundation."): "GPL-2",
        GPL3.replace("General", "Affero General"): "AGPL-3-or-later", GPL3.replace("General", "Lesser General").replace("version 3", "version 2.1").replace("program", "library"): "LGPL-2.1-or-later",
        ZLIB: "Zlib", "   Apache License\n   Version 2.0, January 2004\n   http://www.apache.org/licenses/\n\n   TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION": "Apache-2.0",
        "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions": "MPL-2.0",
        "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright (C) 2007 Free Software Foundation, Inc.\n Everyone is permitted to copy and distribute verbatim copies\n of this license document, but changing it is not allowed.": "GPL-3",
        "Licensed under the BSD 3-Clause License.": "BSD-3-Clause", "This project is licensed under the ISC license.": "ISC", "This work is in the public domain.": "Public-Domain",
    }
    for text, want in cases.items():
        assert [x["license"] for x in licenses_of(text)] == [want], text
    for text in ("You need a license to drive.", "The license was released under pressure.", "He is licensed under the law of the land.", "Permission is a word. Copyright is another."):
        assert licenses_of(text) == [], text


def test_license_scan_of_repeated_rows_and_long_texts(spark):
    long = "plain words of prose. " * 40000 + "\nLicensed under CC0 1.0.\n" + "more words\n" * 20000
    df = spark.createDataFrame([(1, "MIT License"), (1, "MIT License"), (2, long), (3, "license " * 100000), (None, None)], "i int, text string")
    got = sorted(((r.i or 0), [x.license for x in r.licenses]) for r in scan(df).collect())
    assert got == [(0, []), (1, ["MIT"]), (1, ["MIT"]), (2, ["CC0-1.0"]), (3, [])]


def plain_licenses(text):
    """Single-sentence rules by a plain reading of lines, for the generated documents."""
    known = {"released under the mit license": "MIT", "licensed under the apache license, version 2.0": "Apache-2.0",
             "this work is licensed under the gnu general public license, version 3": "GPL-3", "licensed under cc by-nc 4.0": "CC-BY-NC-4.0",
             "all rights reserved": "All-Rights-Reserved"}
    found = []
    for line in (text or "").split("\n"):
        for sentence in line.replace("! ", ". ").replace("? ", ". ").split(". "):
            name = known.get(sentence.strip().rstrip(".").lower())
            if name:
                found.append(name)
    return ",".join(found)


def test_license_query_on_documents(spark, sf):
    from sluice.llm import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.licenses for r in queries.op9_license_rules(spark, sf).collect()}
    assert got == {i: plain_licenses(t) for i, t in docs.items()}


def test_pipeline_stages_match_brute_force(spark, sf):
    import corpus_pipeline as P
    from test_simhash_dedup import groups, plain_fingerprint
    from test_suffix_dedup import brute

    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumnRenamed("lang", "kept").cache()
    first = P.quality(spark, docs, sf)
    assert first.columns == docs.columns
    rows = first.orderBy("doc_id").collect()
    second = sorted(P.near_dedup(spark, first, sf).collect(), key=lambda r: r.doc_id)
    want = groups([r.doc_id for r in rows], [plain_fingerprint(r.text) for r in rows])
    assert [tuple(r) for r in second] == [tuple(r) for r in rows if want[r.doc_id] == r.doc_id]
    third = {r.doc_id: r for r in P.passages(spark, spark.createDataFrame(second, docs.schema), sf).collect()}
    for r, (kept, *_) in zip(second, brute([r.text for r in second]), strict=True):
        text = kept.decode("utf-8", "ignore")
        assert (third[r.doc_id].text, third[r.doc_id].n_chars, third[r.doc_id].source) == (text, len(text), r.source)


def test_pipeline_runs_whole_and_on_nothing(spark, sf):
    import corpus_pipeline as P

    out = P.run(spark, sf).collect()
    fill = {}
    for r in out:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
    assert max(fill.values()) <= 4096 and len(fill) == -(-sum(fill.values()) // 4096)
    nothing = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "x", None, 0), (1, "word " * 20, None, "s", 5), (1, "word " * 20, None, "s", 5),
                                 (2, " ".join(f"w{i}" for i in range(400_000)), "x", "a host of its own", None)], nothing.schema)
    for start in (nothing, odd):
        docs = start
        for _, stage in P.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == start.columns
        pieces = P.packing(spark, docs, sf).collect()
    long = sorted((r.piece, r.start, r.length) for r in pieces if r.doc_id == 2)
    assert len(long) > 100 and all(n == 4096 for _, _, n in long[:-1]) and [s for _, s, _ in long] == [4096 * k for k in range(len(long))]
