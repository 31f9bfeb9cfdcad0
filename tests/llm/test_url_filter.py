import re

from compare import of_spark, of_sql
from hypothesis import given, settings
from hypothesis import strategies as st

from fernweave.llm import url_filter as U

GLOBS = st.lists(st.text("ab*?", max_size=9), min_size=1, max_size=40)


@settings(max_examples=60, deadline=None)
@given(GLOBS, st.lists(st.text("ab", max_size=12), max_size=20))
def test_automaton_equals_regular_expressions(globs, texts):
    hits = U.GlobAutomaton([g.encode() for g in globs]).match([t.encode() for t in texts])
    for j, g in enumerate(globs):
        pattern = re.compile("".join({"*": ".*", "?": "."}.get(c, c) for c in g), re.S)
        assert [bool(pattern.fullmatch(t)) for t in texts] == hits[:, j].tolist()


URLS = [
    None,
    "",
    "example.net/en/",
    "http://Example.NET/en/1",
    "http://a.example.net/en",
    "https://notexample.net/en/x",
    "ftp://x.org/fr/?q=.net/",
    "http://x.org?a",
    "http://x.net#frag",
    "http://x.com/a.net/",
    "http://m.example.com/de/1",
    "http://ÄB.net/é",
    "http://www.cheap-pills.example.com/x",
    "a://b://c.net/x",
    "http://x.com/wp-login.php?x",
    "http:///x",
    "http://x.com/" + "y" * 100_000 + ".exe",
]


def test_query_equals_sql(spark, folder):
    at = folder(pages=[(i, u, None) for i, u in enumerate(URLS)] + [(1, "http://x.net/", None), (None, "http://x.net/", None)])
    assert of_spark(U.op6_url_filter(spark, at)) == of_sql(U.ORACLE, at)


def test_longest_rule_first_of_equals():
    rules = [U.Rule("allow", "b.c", "/"), U.Rule("block", "c", "/de/"), U.Rule("allow", "c", "/dx/")]
    own = U.UrlFilter(rules)
    assert own.judge(["http://a.b.c/de/1"])[0][2:] == ("c/de/", "block")
    assert own.judge(["http://b.c/x"])[0][2:] == ("b.c/", "allow")
    assert own.judge([]) == [] and U.UrlFilter([]).judge(["http://a/"])[0][2:] == (None, "allow")


def test_stars_in_rules_are_literal():
    own = U.UrlFilter([U.Rule("block", "a*b", "/?")])
    assert own.judge(["http://a*b/?"])[0][2] is None and own.judge(["http://axb/x"])[0][2] is None


def test_empty_table_and_clash(spark, folder):
    assert U.op6_url_filter(spark, folder(pages=[])).count() == 0
    df = spark.createDataFrame([(1, "http://x.net/", "clash")], "k int, u string, host string")
    assert U.filter_urls(df, "u", U.BASE_RULES).first().asDict() == {"k": 1, "u": "http://x.net/", "host": "x.net", "path": "/", "rule": "net/", "verdict": "block"}
