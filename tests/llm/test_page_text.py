import random
from collections import defaultdict

import pytest

from gleaner.llm import page_text as pt

SCHEMA = "page_id bigint, url string, html string, text string, lines string, row bigint, host string, at int, own string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "t", "l", 1, "h", 2, "o") for r in rows], SCHEMA)


def extracted(spark, rows, **options):
    return sorted((tuple(r) for r in pt.extract(table(spark, rows), **options).collect()), key=repr)


def texts(markup):
    return [t for t, zone, _ in pt.page_lines(markup) if zone != pt.OUT]


@pytest.mark.parametrize("markup,lines", [
    ("<p>One &amp; two&nbsp;<b>three</b>\n four<p>five<br>six", ["One & two three four", "five six"]),
    ("<script>var t='</p>';</script><style>p{}</style><title>x</title><!-- no --><p>yes", ["yes"]),
    ("<p><b>open<br><p>next</p>tail", ["open", "next", "tail"]),
    ("<nav><ul><li>a</ul></nav><header>h</header><article><header><h1>T</h1></header><p>x</article><footer>f</footer>", ["T", "x"]),
    ('<div class="ad">buy</div><div id="cookie-notice">ok?</div><div class="postComments"><p>me too</div><div class="gradient">g</div>', ["g"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a b", "c"]),
    ('<div hidden>no</div><div style="display: none">no</div><p title="a > b">yes</p>', ["yes"]),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", ["a", "b", "c"]),
    ("a < b and <3 &lt;p&gt; &#233;", ["a < b and <3 <p> é"]),
    ("<p>cut <a href='", ["cut"]),
    ("", []),
    ("<body class='sidebar'><main class='ads'>x</main></body>", ["x"]),
    ("<textarea><p>t</textarea><select><option>o</select><p>after", ["after"]),
])
def test_lines(markup, lines):
    assert texts(markup) == lines


def table_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
    return row[-1]


def test_alignment_is_a_longest_one():
    rng = random.Random(2)
    for size in (3, 12, 40):
        for _ in range(300):
            letters = rng.choice([2, 3, 10])
            a, b = ([rng.randrange(letters) for _ in range(rng.randrange(size))] for _ in range(2))
            found = pt.common_lines(a, b)
            assert all(a[i] == b[j] for i, j in found) and len(found) == table_length(a, b)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:]))


def test_frame_of_a_host_goes_and_articles_stay(spark):
    rng = random.Random(4)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    rows, body = [], {}
    quoted = words(60)
    for n in range(40):
        body[n] = "\n".join([words(12), words(30), words(25)])
        blocks = "".join(f"<p>{p}</p>" for p in body[n].split("\n"))
        rows.append((n, f"https://www.one.example/news/{n}.html", f"<div><span>Home</span></div><div><p>Log in here</p></div><div>{blocks}</div><div><i>All rights reserved {n % 2}</i></div>"))
    for n in range(40, 60):
        body[n] = f"{words(90)}\n{quoted}"
        rows.append((n, f"http://two.example/a/{n}?x=1", f"<div>Top</div><article><p>{body[n].replace(chr(10), '</p><p>')}</p><p class='more'>Read on</p></article><div>Odd words {n}</div>"))
    got = {r[0]: r[2] for r in extracted(spark, rows, block=8)}
    for n in range(60):
        assert got[n] == body[n] or n < 40 and got[n] in (body[n], body[n] + f"\nAll rights reserved {n % 2}"), n


def test_copies_are_no_frame(spark):
    page = "<div><p>The same article as next door, word for word.</p><p>And its second paragraph, too.</p></div>"
    rows = [(n, f"http://copy.example/{n}", page) for n in range(6)]
    assert {r[2] for r in extracted(spark, rows)} == {"The same article as next door, word for word.\nAnd its second paragraph, too."}


def plain_extract(rows):
    """All pages at once, with a plain table for the alignment."""
    def key(url):
        import re
        bare = re.sub(r"^\s*(?:[a-z][a-z0-9+.-]*:)?//", "", (url or "").lower())
        host = re.sub(r"^www\.", "", re.match(r"[^/?#]*", bare)[0])
        path = re.match(r"[^/?#]*([^?#]*)", bare)[1]
        path = re.sub(r"\.(?:html?|php|aspx?)$", "", re.sub(r"/+$", "", path))
        return host, "".join(f"{len(p):04d}{p}" if p[0].isdigit() else p for p in re.findall(r"\d+|\D+", path))

    def aligned(a, b):
        size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                size[i][j] = size[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(size[i + 1][j], size[i][j + 1])
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i][0] == b[j][0]:
                yield i, j
                i, j = i + 1, j + 1
            elif size[i + 1][j] >= size[i][j + 1]:
                i += 1
            else:
                j += 1

    pages = sorted((key(r[1]) + (r[0], r[1], n) for n, r in enumerate(rows)), key=repr)
    lines = [pt.page_lines(r[2] or "") for r in rows]
    hit, met, tally = [set() for _ in rows], set(), defaultdict(lambda: [0, 0])
    for (h, _, _, _, x), (g, _, _, _, y) in zip(pages, pages[1:]):
        if not h or h != g or not lines[x] or not lines[y]:
            continue
        same = list(aligned(lines[x], lines[y]))
        weigh = lambda ls: sum(len(t) ** 2 for t, zone, _ in ls if zone != pt.OUT)
        least = min(weigh(lines[x]), weigh(lines[y]))
        if least and weigh([lines[x][i] for i, _ in same]) > pt.COPY_SHARE * least:
            continue
        met |= {x, y}
        hit[x] |= {i for i, _ in same}
        hit[y] |= {j for _, j in same}
    for h, _, _, _, x in pages:
        for i, (_, zone, place) in enumerate(lines[x] if x in met else ()):
            if zone != pt.OUT:
                cell = tally[h, place, zone]
                cell[0] += 1
                cell[1] += i in hit[x]
    frame = {k[:2] for k, (n, hits) in tally.items() if n >= pt.PLACE_LINES and hits >= (pt.DECLARED_PLACE_SHARE if k[2] == pt.IN else pt.PLACE_SHARE) * n}
    out = []
    for h, _, _, _, x in pages:
        own = [(t, zone) for i, (t, zone, place) in enumerate(lines[x]) if zone != pt.OUT and (h, place) not in frame and (zone == pt.IN or i not in hit[x])]
        main = [t for t, zone in own if zone == pt.IN]
        if main and sum(map(len, main)) >= pt.DECLARED_SHARE * sum(len(t) for t, _ in own):
            own = [(t, pt.IN) for t in main]
        text = "\n".join(t for t, _ in own)
        out.append((rows[x][0], rows[x][1], text, len(text)))
    return sorted(out, key=repr)


def test_against_a_plain_version(spark):
    rng = random.Random(8)
    pool = [f"line {n} " + "word " * rng.randrange(12) for n in range(400)]
    rows = []
    for n in range(300):
        # no line twice on a page, so that the longest alignment is one
        body = "".join(f"<{t}>{x}</{t}>" for x, t in zip(rng.sample(pool[20:], rng.randrange(6)), rng.choices(["p", "div", "h2", "li"], k=6)))
        top = "".join(f"<div class='t{n % 3}'>{pool[k]}</div>" for k in sorted(rng.sample(range(12), 3)))
        body = f"<article>{body}</article>" if n % 3 == 0 else body
        host = rng.choice(["a.example", "www.a.example", "b.example", "c.example"])
        rows.append((n, f"http://{host}/x/{n * 7 % 311}/", f"<html><body>{top}{body}<footer>{pool[12 + n % 5]}</footer></body></html>"))
    assert extracted(spark, rows, block=4) == plain_extract(rows)
    assert extracted(spark, rows, block=32) == plain_extract(rows)


def test_odd_rows(spark):
    long = "<p>" + "many words here " * 100_000 + "</p>"
    rows = [
        (1, None, "<p>No host."), (None, "http://h.example/", None), (2, "", ""), (3, "http://h.example/a", "<p>A page."), (3, "http://h.example/a", "<p>A page."),
        (3, "http://h.example/a", "<p>A page."), (4, "nonsense", "plain"), (5, "http://h.example/b", long), (6, "http://h.example/c", "<div>" * 3000 + "deep"), (None, None, None),
    ]
    got = extracted(spark, rows)
    assert len(got) == len(rows) and [r[2] for r in got if r[0] == 3] == ["A page."] * 3
    assert next(r for r in got if r[0] == 5)[3] == 100_000 * 16 - 1
    assert next(r for r in got if r[0] == 6)[2] == "deep" and next(r for r in got if r[0] == 1)[2] == "No host."
    assert all(r[2] == "" and r[3] == 0 for r in got if r[0] is None)


def test_no_pages(spark):
    assert extracted(spark, []) == []
