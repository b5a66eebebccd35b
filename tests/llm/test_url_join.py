"""Long rule lists give what the trie gives, whatever the ids."""

from loomlex.llm import urlfilter


def test_join_with_null_and_repeated_ids(spark):
    table = spark.createDataFrame([(None, "http://b.net/"), (None, "http://x.org/fr/"), (6, "http://b.net/"), (6, "http://a.example.net/en/x"), (6, "junk"), (7, None)], "page_id long, url string")
    rules = spark.createDataFrame([*urlfilter.RULES], "host string, path string, verdict string")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(urlfilter.match_by_join(table, rules)) == rows(urlfilter.match(table))
