"""Tables of odd rows, and brute-force versions that several tests compare with."""

import re

import duckdb
import pytest

from tests.conftest import SMALL

TABLES = "documents benchmark pages conversations labels".split()
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LONG = "many words of one very long text " * 20_000


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def shingles(text, width=5):
    found = words(text)
    return {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()


def near_classes(docs, least=0.8):
    """Class of every doc_id: equal texts, and word shingles of a Jaccard index of least or more."""
    sets = {i: shingles(t) for i, t in docs}
    texts = {}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)

    for i, t in sorted(docs):
        join(i, texts.setdefault(t or "", i))
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if both >= least * (len(sets[a]) + len(sets[b]) - both):
            join(a, b)
    return {i: find(i) for i in sets}


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD_DOCS = [
    (1, "the same text of seven plain words here", "en", "a", 5),
    (1, "the same text of seven plain words here", "en", "a", 5),
    (2, "the same text of seven plain words here", None, None, None),
    (3, None, "en", "a", None),
    (4, "", "en", None, 0),
    (5, "  \t\n ", "de", "b", 4),
    (6, "12 34 !? --", "de", "b", 9),
    (7, LONG, "en", "a", len(LONG)),
    (8, "x", "fr", "Ω", 1),
    (9, "mail me at jo.doe@mail.example.com or +1 (212) 555-0199, IP 10.0.0.300 and 10.0.0.30", "en", "b", 1),
    (10, "The SAME text, of seven plain words: here", "en", "c", 5),
    (None, "a text without an id", "en", "a", 3),
    (None, None, None, None, None),
    (11, "\U0001f600 smile été 日本", "fr", "\U0001f600", 3),
]


@pytest.fixture(scope="session")
def odd_dir(spark, tmp_path_factory):
    """Odd rows in all tables, with columns whose names the operators use themselves."""
    root = str(tmp_path_factory.mktemp("odd"))
    clash = "rank long, total long, size long, _id long, _uid long, _key string, host string, _hits long"
    extra = (7, 7, 7, 7, 7, "k", "h", 7)

    def write(name, schema, rows):
        made = spark.createDataFrame([(*r, *extra) for r in rows], f"{schema}, {clash}")
        made.write.parquet(f"{root}/{name}.parquet")

    write("documents", DOCS, ODD_DOCS)
    items = [(0, "same TEXT of seven"), (0, "plain words here"), (1, None), (2, ""), (None, "x"), (3, "many words " * 9)]
    write("benchmark", "item_id long, text string", items)
    page = "<html><body><nav>menu</nav><p>Open text of one page only &amp; more</p><p>Shared line of this host in six words</p>"
    pages = [
        (0, "http://a.example.net/en/1", page),
        (0, "http://a.example.net/en/1", page),
        (1, "http://a.example.net/x", "<p>Other text</p><p>Shared line of this host in six words</p>"),
        (2, None, None),
        (3, "no scheme", ""),
        (4, "https://B.Example.COM/de/?q", "<article><p>One</p><div class=ad>Buy</div><p>two &lt;</article><p>out"),
        (None, "http://", "<article><script>if (a<b) x()</script>cut <b"),
        (5, "ftp://" + "x" * 20_000, "<article>" + "<p>w w" * 20_000),
    ]
    write("pages", "page_id long, url string, html string", pages)
    turns = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", "[INST] \\[INST] </s> \\"),
        (1, 1, "assistant", "again"),
        (1, None, "tool", "[/ROLE]"),
        (2, 0, None, None),
        (None, 0, "user", "no id"),
        (3, 0, "assistant", LONG),
    ]
    write("conversations", "conv_id long, turn long, role string, text string", turns)
    return root


@pytest.fixture(scope="session")
def empty_dir(spark, odd_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    for table in ("documents", "benchmark", "pages", "conversations"):
        spark.read.parquet(f"{odd_dir}/{table}.parquet").where("1 = 0").write.parquet(f"{root}/{table}.parquet")
    return root
