import html
import random
import re

from siltstone.llm import html_text as H
from siltstone.llm.common import table
from tests.conftest import SMALL


def test_marked_articles_equal_the_plain_pattern(spark):
    pages = {r.page_id: r.html for r in table(spark, SMALL, "pages").collect()}
    got = {r.page_id: r for r in H.op9_host_suffixes(spark, SMALL).collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
        plain = html.unescape(re.sub(r"<[^>]*(?:>|\Z)", " ", article)).split()
        assert got[i].text.split() == plain and got[i].n_chars == len(got[i].text)


def article(inside):
    return H.page_blocks(f"<html><body><nav>m</nav><article>{inside}</article><footer>f</footer></body></html>")[0]


def test_blocks_and_white_space():
    assert article("<h1>A  b</h1><p>c<br>d\n e<p>f<b>g</b>h<ul><li>i<li>j</ul>k") == ["A b", "c d e", "fgh", "i", "j", "k"]
    assert article("&lt;p&gt; &amp;amp; &eacute;&#65;&amp") == ["<p> &amp; éA&"]
    assert article("<p></p> <p> &nbsp; </p>") == []


def test_furniture_inside_articles_goes():
    for noise in (
        "<aside>x</aside>",
        "<div class='ad top'><p>x</p></div>",
        "<form><p>x<input></form>",
        "<section id=comments><article class=comment><p>x</article></section>",
        "<script>if (a < b) '</p>'</script>",
        "<style>p{}</style><!-- x <p> --><noscript><p>x</p></noscript>",
        "<div role=navigation>x</div><p hidden>x</p>",
        '<div data-x=">" class="share-buttons">x</div>',
    ):
        assert article(f"<p>one</p>{noise}<p>two</p>") == ["one", "two"], noise
    assert H.page_blocks("<article class='post comments-open'>a<p class=adapted>b</article>")[0] == ["a", "b"]


def test_pages_cut_off():
    assert H.page_blocks("<article><p>one <b")[0] == ["one"]
    assert H.page_blocks("<article><p>one <a href=\"x y")[0] == ["one"]
    assert H.page_blocks("<article><p>one<script>var a")[0] == ["one"]
    assert H.page_blocks("<article><p>one<!-- two")[0] == ["one"]
    assert H.page_blocks("<article><p>1 < 2 and 3 &am")[0] == ["1 < 2 and 3 &am"]
    assert H.page_blocks(None) == ([], [], False)


def test_a_class_word_alone_does_not_empty_a_page():
    assert H.page_blocks('<div class="header-image article"><p>main here</div>')[0] == ["main here"]
    assert H.page_blocks('<div class="header-image"><p>main here</div>')[0] == ["main here"]
    assert H.page_blocks('<div class="header-image"><p>x</div><p>main here')[0] == ["main here"]
    assert H.page_blocks('<div class="comments post"><p>main here</div>')[0] == []


def _runs(blocks, heads):
    """Every run of a page, as tokens and the blocks that it holds whole."""
    out = []
    for k, block in enumerate(blocks):
        first = max([i for i in range(k + 1) if heads[i]], default=0)
        last = min([i for i in range(k + 1, len(blocks)) if heads[i]], default=len(blocks))
        n = max(H.LONG, len(block.split(" ")))
        after, before = " ".join(blocks[k:last]).split(" ")[:n], " ".join(blocks[first : k + 1]).split(" ")[-n:]
        if len(after) == n:
            out.append((after, [j for j in range(k, last) if len(" ".join(blocks[k : j + 1]).split(" ")) <= n]))
        if len(before) == n:
            out.append((before, [j for j in range(first, k + 1) if len(" ".join(blocks[j : k + 1]).split(" ")) <= n]))
    return out


def _kept(pages):
    """Every page's text, by comparing each run with all places of all pages of its host."""
    read = {i: (url.split("/")[2], *H._placed_blocks(html)) for i, url, html in pages}
    out = {}
    for i, (host, own, every, heads, marked) in read.items():
        others = [o for o in read.values() if o[0] == host]
        bodies = len({tuple(o[2]) for o in others})
        least, share = (H.MARKED_LEAST, H.MARKED_SHARE) if marked else (H.OPEN_LEAST, H.OPEN_SHARE)

        def often(run, bodies=bodies, others=others, least=least, share=share):
            rests = set()
            for _, _, blocks, heads, _ in others:
                for tokens, held in _runs(blocks, heads):
                    if tokens == run:
                        rests.add(tuple(sorted(b for k, b in enumerate(blocks) if k not in held)))
            return len(rests) >= max(least, share * bodies)

        gone = {k for run, held in _runs(every, heads) if often(run) for k in held if k in own}
        words = {k: len(every[k].split(" ")) for k in own}
        if sum(words[k] for k in gone) > H.VERSION * sum(words.values()):
            gone = set()
        out[i] = "\n\n".join(every[k] for k in own if k not in gone)
    return out


def _texts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in H.main_text(df).collect()}


MORE = "Read more of our stories every single day on this site, sign up now."


def _story(i, words=30):
    return " ".join(f"w{i}x{k}" for k in range(words))


def test_what_a_host_repeats_goes_from_marked_articles_too(spark):
    def page(i, last):
        return f"<article><h1>Title {i}</h1><p>{_story(i)}</p><p>{last}</p></article>"

    pages = [(i, f"http://h.example/{i}", page(i, MORE)) for i in range(3)]
    pages += [(10 + i, f"http://two.example/{i}", page(i, MORE)) for i in range(2)]
    pages += [(20 + i, f"http://some.example/{i}", page(i, MORE if i < 3 else "end")) for i in range(5)]
    pages += [(30 + i, "http://copy.example/", page(1, MORE)) for i in range(4)]
    got = _texts(spark, pages)
    assert got == _kept(pages)
    assert got[0] == f"Title 0\n\n{_story(0)}"
    assert all(MORE in got[i] for i in got if i >= 10 and i not in (23, 24))  # two pages, too few of five, copies of one


def test_unmarked_pages_lose_whole_blocks_only(spark):
    menu = "".join(f"<li>{w}</li>" for w in "Home About us Contact Imprint Help Jobs Press Shop".split())
    fox = "The quick brown fox jumps over the lazy dog number {} today."
    pages = [
        (i, f"http://h.example/{i}", f"<ul>{menu}</ul><h2>Summary</h2><p>{_story(i)}</p><p>{fox.format(i)}</p><p>{MORE}</p>")
        for i in range(6)
    ]
    same = f"<p>{_story(99)}</p><p>short</p>"
    pages += [(50 + i, f"http://s.example/{i}", f"<{tag}>{same}</{tag}>") for i, tag in enumerate(("div", "section"))]
    pages += [(60 + i, f"http://v.example/{i}", f"<div>menu {i}</div>{same}") for i in range(4)]
    got = _texts(spark, pages)
    assert got == _kept(pages)
    assert all(got[i] == f"Summary\n\n{_story(i)}\n\n{fox.format(i)}" for i in range(6))
    assert got[50] == got[51] == f"{_story(99)}\n\nshort"
    assert all(_story(99) in got[i] for i in range(60, 64))  # versions of one page


def test_random_pages_equal_brute_force(spark):
    rng = random.Random(5)
    runs = [" ".join(f"r{k}t{j}" for j in range(n)) for k, n in enumerate((1, 2, 3, 7, 8, 9, 14))]
    pages = []
    for i in range(80):
        blocks = [rng.choice(runs) if rng.random() < 0.6 else _story(i * 100 + k, rng.randrange(1, 20)) for k in range(rng.randrange(1, 9))]
        html = "".join(f"<{tag}>{b}</{tag}>" for b in blocks for tag in [rng.choice(["p", "p", "p", "h2"])])
        pages.append((i, f"http://h{i % 7}.example/{i}", f"<article>{html}</article>" if i % 3 else html))
    assert _texts(spark, pages) == _kept(pages)


def test_odd_rows(spark, odd_dir):
    rows = H.op9_host_suffixes(spark, odd_dir).collect()
    got = {}
    for r in rows:
        got.setdefault(r.page_id, []).append(r.text)
    assert len(rows) == 8 and len(got[0]) == 2
    assert got[0] == ["Open text of one page only & more"] * 2 and got[1] == ["Other text"]
    assert got[2] == got[3] == [""] and got[4] == ["One\n\ntwo <"] and got[None] == ["cut"]
    assert got[5][0].count("\n\n") == 19_999


def test_nothing(spark, empty_dir):
    assert H.op9_host_suffixes(spark, empty_dir).count() == 0
