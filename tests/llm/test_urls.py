"""Rules, aliases and precedence."""

from concordat.llm import urls
from concordat.llm.components import connected
from concordat.llm.queries import RULES


def page(target, kind="canonical"):
    if kind == "canonical":
        return f"<html><head><link href='{target}' rel=\"canonical\"></head></html>"
    return f'<meta http-equiv="refresh" content="0; url={target}">'


def test_verdicts(spark, frame):
    rows = [
        (1, "https://WWW.Example.org/es/9?x=1#y", None),
        (2, "http://a.example.org/en/12", ""),
        (3, "http://a.example.org/en/2", "<p>"),
        (4, "http://b.example.com/de/1", None),
        (5, "http://x.net/copy", page("https://b.example.com/de/1")),
        (6, "http://x.net/second", page("/copy")),
        (7, "http://y.com/fr/1", page("http://x.net/copy")),  # an explicit allow stands
        (8, "http://z.net/old?a=1&b=2", page("http://z.net/new", "refresh")),
        (9, "http://z.net/new", page("#top")),
        (10, "no url", page("http://x.net/copy")),
        (11, None, None),
        (12, "", ""),
        (13, "ftp://org", None),
        (14, "http://org/", None),
        (15, "http://forg/", None),
        (16, "http://x.net/to", page("http://y.example.org/es/never-fetched")),
        (17, "//x.net/second", None),
        (5, "http://x.net/copy", page("https://b.example.com/de/1")),
        (18, "http://com?/de/", None),
        (None, "http://com/de/", None),
    ]
    docs = frame(rows, "page_id long, url string, html string").selectExpr("*", "page_id as node", "url as host", "html as rule")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(docs, urls.rule_table(spark, RULES)).collect()}
    assert got[1] == ("www.example.org", "/es/9", "example.org/es/", "block")
    assert got[2] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert got[3] == ("a.example.org", "/en/2", "org/", "allow")
    assert got[4] == ("b.example.com", "/de/1", "com/de/", "block")
    assert got[5] == ("x.net", "/copy", None, "block")
    assert got[6] == ("x.net", "/second", None, "block")
    assert got[7] == ("y.com", "/fr/1", "com/fr/", "allow")
    assert got[8][3] == got[9][3] == "allow"
    assert got[10] == ("", "", None, "allow") and got[11] == ("", "", None, "allow") and got[12] == ("", "", None, "allow")
    assert got[13] == ("org", "", None, "allow") and got[14] == ("org", "/", "org/", "allow") and got[15][2] is None
    assert got[16][3] == "block" and got[17] == ("", "", None, "allow")
    assert got[18] == ("com", "", None, "allow") and got[None] == ("com", "/de/", "com/de/", "block")
    assert urls.judge(docs, urls.rule_table(spark, RULES)).count() == len(rows)
    assert urls.judge(docs.limit(0), urls.rule_table(spark, RULES)).collect() == []


def test_link_forms(spark, frame):
    """Which tags of a page are read: each page is blocked if the link to a blocked page counts."""
    bad = "http://b.example.com/de/1"
    forms = {
        1: (f'<link rel="canonical" data-href="/x" href="{bad}">', True),
        2: (f'<!-- <link rel="canonical" href="{bad}"> -->', False),
        3: (f'<link rel="canonical" href="#"><link rel=canonical href={bad}>', True),
        4: (f"<LINK HREF='{bad}' REL='alternate Canonical'>", True),
        5: (f'<link rel="not-canonical" href="{bad}">', False),
        6: (f'<link rel="stylesheet" title="rel=canonical" href="{bad}">', False),
        7: (f'<script>x = \'<link rel="canonical" href="{bad}">\'</script><p>', False),
        8: (f'<meta content="0;URL=\'{bad}\'" http-equiv=Refresh>', True),
        9: (f'<meta name="refresh" content="0; url={bad}">', False),
        10: ('<meta http-equiv="refresh" content="5">', False),
        11: (f'<link rel="canonical" title="href=/other" href=" {bad} ">', True),
        12: (f'<!-- never closed <link rel="canonical" href="{bad}">', False),
        13: (f'<link rel="canonical" href="//b.example.com/de/1">' + "<p class=x>" * 20_000, True),
        14: ("<link " + "canonical" * 20_000, False),
        15: ("<link" + ' rel="canonical"' * 5_000 + f' href="{bad}">', True),
    }
    pages = frame([(i, f"http://site{i}.net/page", html) for i, (html, _) in forms.items()], "page_id long, url string, html string")
    got = {r.page_id: r.verdict == "block" for r in urls.judge(pages, urls.rule_table(spark, RULES)).collect()}
    assert got == {i: blocked for i, (_, blocked) in forms.items()}


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 102), (5, 5), (200, 200), (None, 3)] + [(1000, 2000 + i) for i in range(50)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    expected = {i: 0 for i in range(31)} | {100: 100, 101: 100, 102: 100, 200: 200, 1000: 1000} | {2000 + i: 1000 for i in range(50)}
    assert got == expected
