from barsignal.llm import html_text
from barsignal.llm.common import prepare


def test_inner_pages_of_a_long_run_of_copies_are_differenced(spark):
    prepare(spark)

    def page(k):
        return f"<body><p>Our site</p><p>Story {k} begins</p><div>and {k} goes on</div><p>All about us</p></body>"

    rows = [(k, f"http://h.example/a/{k:03}", page("copied")) for k in range(30)] + [(90, "http://h.example/a/090", page("other"))]
    rows += [(91, "http://h.example/a/015m", "<body><article>" + page("copied")[6:-7] + "</article></body>")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[k] == "Story copied begins\nand copied goes on" for k in range(30))
    assert got[90] == "Story other begins\nand other goes on"
    assert got[91] == "Our site\nStory copied begins\nand copied goes on\nAll about us"
