from gleanwell import CrawlConfig, register_views


def test_views_answer_sql(spark):
    html = '<body><a href="/a.mp3">talk</a><a href="/b">Terms</a><p>hello</p></body>'
    pages = spark.createDataFrame([(1, "http://h.com/", html)], "page_id bigint, url string, html string")
    register_views(spark, pages, CrawlConfig())
    assert [tuple(r) for r in spark.sql("SELECT url, action FROM links ORDER BY pos").collect()] == [
        ("http://h.com/a.mp3", "media"), ("http://h.com/b", "drop" if CrawlConfig().depth == 1 else "follow"),
    ]
    assert spark.sql("SELECT license_urls FROM media_items").first()[0] == ["http://h.com/b"]
    assert spark.sql("SELECT texts FROM page_texts").first()[0] == ["talk", "Terms", "hello"]
    assert spark.sql("SELECT count(*) FROM anchors").first()[0] == 2
    assert spark.sql("SELECT license_urls FROM page_licenses").first()[0] == ["http://h.com/b"]
