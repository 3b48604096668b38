"""The listed hosts of op7 follow from the table, whatever the domain endings."""

import re

import pytest

from sluice.llm import queries, url_cascade


def test_sites_are_listed_under_any_ending(spark):
    urls = ["http://spam-farm.example.net/a", "http://m.Free-Bets.example.co/b", "http://x.org/spam-farm/", None, "none", "http://not-spam-farm.org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = url_cascade.site_hosts(pages, queries.BLOCKED_SITES)
    assert sorted(r.key for r in listed.collect()) == ["free-bets.example.co", "spam-farm.example.net"]
    got = {r.page_id: r.verdict for r in url_cascade.judge_urls(pages, (), listed).collect()}
    assert [got[i] for i in range(6)] == ["block", "block", "allow", "allow", "allow", "allow"]


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_every_junk_host_is_a_listed_key(spark, size):
    pages = spark.read.parquet(f"/root/testdata/{size}/pages.parquet")
    name = re.compile(rf"(?:^|\.)((?:{'|'.join(queries.BLOCKED_SITES)})\..+)")
    want = set()
    for r in queries.op7_url_cascade(spark, f"/root/testdata/{size}").collect():
        m = name.search(r.host)
        want |= {m[1]} if m else set()
        assert r.rule or r.verdict == ("block" if m else "allow")
    got = {r.key for r in url_cascade.site_hosts(pages, queries.BLOCKED_SITES).collect()}
    assert got == want and not got <= set(queries.BLOCKED_HOSTS)
