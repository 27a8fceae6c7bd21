import collections
import datetime
import random
import re

from pyspark.sql import functions as F

from leadwright.llm import queries, tools, url_lists

DAY = datetime.datetime(2024, 3, 1)


def at(hours):
    return None if hours is None else DAY + datetime.timedelta(hours=hours)


def brute(captures, entries):
    last = {}
    for lst, pattern, action, hours in entries:
        if None not in (lst, pattern, action, hours):
            key = (lst, pattern.lower(), hours)
            last[key] = max(last.get(key, ""), action)
    out = []
    for page, url, hours in captures:
        m = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url or "")
        active = []
        if m and hours is not None:
            host, path = m[1].lower().rstrip("."), re.match(r"[^/?#]*//[^/?#]*([^?#]*)", url)[1].lower()
            for lst, pattern in {(a, b) for a, b, _ in last}:
                ph, _, pp = pattern.partition("/")
                pp = "/" + pp if "/" in pattern else ""
                if not (host == ph or host.endswith("." + ph)) or not (pp == "" or path == pp or pp.endswith("/") and path.startswith(pp)):
                    continue
                times = [t for a, b, t in last if (a, b) == (lst, pattern) and t <= hours]
                if times and last[lst, pattern, max(times)] == "add":
                    active.append((lst == "allow", len(pattern), pattern, lst, at(max(times))))
        best = max(active, default=None)
        out.append((page, url, at(hours), bool(best and not best[0]), len(active), *((best[3], best[2], best[4]) if best else (None, None, None))))
    return collections.Counter(out)


def found(spark, captures, entries, days=30):
    caps = spark.createDataFrame([(a, b, at(c), 1, "x") for a, b, c in captures], "id long, url string, fetch_time timestamp_ntz, bucket int, pattern string")
    ents = spark.createDataFrame([(a, b, c, at(d), 5) for a, b, c, d in entries], "list string, pattern string, action string, at timestamp_ntz, day int")
    return collections.Counter(tuple(r) for r in url_lists.judge(caps, ents, days).collect())


def test_random_lists_with_a_hot_host_and_ties(spark):
    rng = random.Random(8)
    hosts = ["hot.example.com"] * 6 + ["a.example.com", "example.com", "b.c.d.org", "d.org", "x.net"]
    url = lambda: f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', ':80', '.'])}{rng.choice(['', '/', '/en/', '/en/x', '/EN/y?q#f', '?en/'])}"
    captures = [(i, url(), rng.randrange(0, 2400)) for i in range(400)]
    patterns = ["hot.example.com", "example.com", "hot.example.com/en/", "d.org", "D.org/en/x", "x.net", "com"]
    entries = [(rng.choice(["block", "block", "allow"]), rng.choice(patterns), rng.choice(["add", "remove"]), rng.randrange(0, 200) * 12) for _ in range(150)]
    entries += [("block", "x.net", a, 600) for a in ("add", "remove", "add")]
    want = brute(captures, entries)
    for days in (1, 30):
        assert found(spark, captures, entries, days) == want


def test_awkward_rows(spark):
    captures = [(1, None, 5), (2, "", 5), (3, "no url", 5), (4, "http://x.net/a", None), (5, "http://user:pw@X.NET:8080/a/b", 5), (5, "http://user:pw@X.NET:8080/a/b", 5),
                (None, "http://x.net", 5), (6, "http://x.net/" + "a/" * 300, 0), (7, "ftp://y", -100)]
    entries = [("block", "x.net", "add", 0), ("block", "x.net", "add", 0), (None, "x.net", "add", 0), ("block", None, "add", 0), ("block", "x.net", None, 3), ("block", "y", "add", None)]
    assert found(spark, captures, entries) == brute(captures, entries)
    assert found(spark, [], entries) == collections.Counter()
    assert found(spark, captures, []) == brute(captures, [])


def test_every_event_becomes_an_entry(spark, small):
    pages, events = tools.documents(spark, small, "pages"), tools.documents(spark, small, "events")
    entries = queries.dated_entries(pages, events)
    kinds = ("signup", "purchase", "error", "click")
    assert entries.filter("pattern <> ''").count() == events.filter(F.col("event_type").isin(*kinds)).count()
    assert queries.dated_entries(pages.limit(0), events).count() == queries.dated_entries(pages, events.limit(0)).count() == 0
