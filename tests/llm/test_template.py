import random
from collections import defaultdict

import pytest

from wicketflow.llm import queries, template


def page(i, body):
    return (f"<html><head><title>T{i}</title><style>p{{}}</style></head><body>"
            f"<nav><a href='/'>Home</a></nav><div class='content'>{body}"
            f"<p>Read more on this site</p></div><footer>(c) us</footer>"
            f"<script>var x = '<p>no</p>';</script></body></html>")


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://A.example:80/{i}", page(i, f"<h1>Title {i}</h1><p>Body  of\n{i} &amp; co "
                                                 f"&lt;x&gt;</p>"), "clash") for i in range(8)]
    rows += [(10, "http://b.example/x", "<p>alone</p><aside>ad</aside>", "clash"),
             (11, None, "no markup at all", "clash"), (12, "http://a.example/n", None, None),
             (13, "http://a.example/e", "", "clash"),
             (14, "http://c.example/", "<div><article><header><h1>H</h1></header><p>one <b>two"
              "</b></p><div class='ad-banner'>buy</div><ul><li>x<li>y</ul></article>"
              "<section id='comments'><p>first!</p></section></div>", "clash"),
             (15, "http://c.example/l", "<p>" + "long word " * 50_000 + "</p>", "clash"),
             rows[0]]
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string")


def test_slots_of_the_template(pages):
    got = template.extract(pages).collect()
    assert len(got) == pages.count()
    texts = {r.page_id: r.text for r in got}
    for i in range(8):
        assert texts[i] == f"Title {i}\nBody of {i} & co <x>"
    assert texts[10] == "alone" and texts[11] == "no markup at all"
    assert texts[12] == texts[13] == ""
    assert texts[14] == "H\none two\nx\ny"
    assert texts[15] == ("long word " * 50_000).strip()


def plain(rows):
    """Texts of (id, host, html) rows from whole occurrence vectors."""
    by_host, texts = defaultdict(dict), {}
    for _, host, html in rows:
        by_host[host][html or ""] = template.parse(html)
    fixed, mains = defaultdict(set), {}
    for host, pages in by_host.items():
        vectors, chars, n = defaultdict(dict), defaultdict(int), len(pages)
        for html, parsed in pages.items():
            for path, _ in parsed.tags:
                vectors["tag", path][html] = vectors["tag", path].get(html, 0) + 1
            for text, path, chrome, _ in parsed.blocks:
                if not chrome:
                    vector = vectors["text", path, text]
                    vector[html] = vector.get(html, 0) + 1
        valid = {k: v for k, v in vectors.items() if len(v) >= 4 and len(v) > 0.5 * n}
        for key, vector in valid.items():
            if key[0] == "text":
                steps = key[1].split("/")
                if any(valid.get(("tag", "/".join(steps[:i + 1]))) == vector
                       for i in range(len(steps))):
                    fixed[host].add(key[1:])
        if not any(k[0] == "tag" for k in valid):
            continue
        for key, vector in vectors.items():
            if key[0] == "text" and key[1:] not in fixed[host]:
                steps = key[1].split("/")
                for i, step in enumerate(steps):
                    if step.partition(".")[0] not in template.HOLDERS:
                        break
                    path = "/".join(steps[:i + 1])
                    if not path or ("tag", path) in valid:
                        chars[path] += len(key[2]) * sum(vector.values())
        held = [p for p, c in chars.items() if c >= 0.6 * chars[""]]
        if held:
            main = max(held, key=len).split("/")
            inner = [i for i, s in enumerate(main) if s.partition(".")[0] in ("article", "main")]
            mains[host] = "/".join(main[:inner[0] + 1] if inner else main)
    for i, host, html in rows:
        blocks = [b for b in by_host[host][html or ""].blocks
                  if not b[2] and (b[1], b[0]) not in fixed[host]]
        main = mains.get(host)
        inside = [b for b in blocks if main is not None
                  and (b[1] + "/").startswith(main + "/" if main else "")]
        texts[i] = "\n".join(b[0] for b in inside or [b for b in blocks if b[3]] or blocks)
    return texts


def test_whole_texts_against_whole_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = table.select("page_id", template.host_of(table.url), "html").collect()
    got = {r.page_id: r.text for r in queries.op7_html_extraction(
        spark, "/root/testdata/sf0.01").collect()}
    assert got == plain([tuple(r) for r in rows])


def made_up(seed):
    """Pages of a host with constant texts under names that mean nothing, here and there."""
    rng, out = random.Random(seed), []
    for i in range(9):
        body = [f"<p>{' '.join(rng.choices('abcdefgh', k=9))} {i}-{j}</p>" for j in
                range(rng.randrange(2, 5))]
        body.insert(rng.randrange(len(body)), "<div class='zq1'><p>Read also our other"
                                              " stories</p></div>")
        if rng.random() < 0.6:
            body.append("<blockquote><p>the same in some</p></blockquote>")
        wrap = ["article", "section", "div class='b'", "main"][seed]
        out.append(f"<body><div class='k9 w-1/2'>Sale today</div><{wrap}><h1>T {i}</h1>"
                   f"{''.join(body)}</{wrap.split()[0]}><div class='x7'><span>All rights</span></div></body>")
    return out


@pytest.mark.parametrize("seed", range(4))
def test_made_up_hosts(spark, seed):
    rows = [(i, f"http://h{seed}.example/{i}", h) for i, h in enumerate(made_up(seed))]
    rows += [(20, f"http://h{seed}.example/copy", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.extract(df).collect()}
    assert got == plain([(i, "h", h) for i, _, h in rows])
    for text in got.values():
        assert "Read also" not in text and "Sale today" not in text and "rights" not in text
        assert "T " in text
    # Without the template the constant texts stay.
    assert all("Read also" in template.page_text(h, None, set()) for _, _, h in rows)


def test_whole_table_and_empty_table(spark, small):
    table = spark.read.parquet(f"{small}/pages.parquet")
    got = queries.op7_html_extraction(spark, small).collect()
    assert sorted(r.page_id for r in got) == sorted(r.page_id for r in table.collect())
    for r in got:
        assert r.n_chars == len(r.text) and "<script" not in r.text
        assert all(line == " ".join(line.split()) and line for line in r.text.split("\n")) \
            or not r.text
    assert template.extract(table.where("false")).count() == 0
