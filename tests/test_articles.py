import pandas as pd
import pytest

from millrace.operators import scoring
from millrace.operators.articles import article_text, extract_articles

BAR = "=" * 80


def heading(text):
    return f"\n{BAR}\n{text}\n{BAR}\n"


@pytest.mark.parametrize("page, wanted", [
    ("", ""), (None, ""), ("<p>outside</p>", ""),
    ("<article><p>One</p></article>", "One\n"),
    ("<main><p>Main</p></main><article><p>Article</p></article>", "Article\n"),
    ("<main><p>Main</p></main>", "Main\n"),
    ("<article><p>1</p></article><article><p>2</p></article>", "1\n"),
    ("<article><h1>Big &amp; bold</h1><p>x</p></article>", heading("BIG & BOLD") + "\nx\n"),
    ("<article><h4>kept out</h4><div>also</div><p> in </p></article>", "in\n"),
    ("<article><p>a <code>b</code> c</p><pre><p>gone</p></pre></article>", "a  c\n"),
    ("<article><p><code>only code</code></p></article>", ""),
    # a list is there as a whole and then item by item
    ("<article><ul><li>x</li><li>y</li></ul></article>", "xy\n\nx\n\ny\n"),
    ("<article><ol>\n<li>x</li>\n<li>y</li>\n</ol></article>", "x\ny\n\nx\n\ny\n"),
    # paragraphs that are never closed hold what follows
    ("<article><p>a<p>b</article><p>c</p>", "ab\n\nb\n"),
    ("<article><p><b>a<br><p>b</p>c</article>", "abc\n\nb\n"),
    ("<article><p>a</b></i></p></p>b<p>c</p></article>", "a\n\nc\n"),
    ("<article><p>a<script>x</script><style>y</style><!-- z --><template>t</template>b</p></article>", "ab\n"),
    ("<article><p>a<img src='x'/>b<br/>c</p></article>", "abc\n"),
    ("<article><p>&lt;tag&gt; &#65;&#x42; &copy; &unknown;</p></article>", "<tag> AB © &unknown\n"),
    ("<ARTICLE><P>Case</P></ARTICLE>", "Case\n"),
    ("<article><article><p>in</p></article><p>still in</p></article><p>out</p>", "in\n\nstill in\n"),
    ("<article><p>one</p>   \n  <p>  </p><h2>ß</h2></article>", "one\n\n" + heading("SS")),
])
def test_article_text(page, wanted):
    assert article_text(page) == wanted


def test_rejected_markup_gives_null():
    assert article_text("<article><p>x</p><![strange[y]]></article>") is None


def test_in_spark(spark, rows):
    pages = spark.createDataFrame([(1, "<article><p>é</p></article>"), (2, None)], "page_id int, html string")
    assert rows(extract_articles(pages).select("page_id", "article"), "page_id") == [(1, "é\n"), (2, "")]


def test_user_functions(spark, rows):
    df = spark.range(5).withColumnRenamed("id", "n")
    doubled = scoring.map_task(df, lambda frame: frame.assign(n=frame.n * 2), "n bigint")
    assert [r[0] for r in rows(doubled, "n")] == [0, 2, 4, 6, 8]

    def load():
        return lambda n: pd.Series(n * 0.5)
    assert [r[1] for r in rows(scoring.score_batches(df, load, ["n"]), "n")] == [0, .5, 1, 1.5, 2]
    assert [r[1] for r in rows(scoring.score(df, lambda n: n * 0.5, ["n"]), "n")] == [0, .5, 1, 1.5, 2]


def test_churn_model_learns(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i % 10), float(i % 3), (i % 10) < 3) for i in range(200)],
                               "id int, visits double, noise double, churned boolean")
    model = scoring.train_churn(df, ["visits", "noise"], str(tmp_path / "model"))
    scored = scoring.score_churn(model, df).collect()
    assert {r.churn_predicted == float(r.churned) for r in scored} == {True}
    assert all(0 <= r.churn_probability <= 1 for r in scored)


def test_moments_agree_at_the_optimum_only(spark, tmp_path):
    df = spark.createDataFrame([(float(i % 7), float(i % 5), (i * 7919) % 11 < 4) for i in range(400)],
                               "visits double, noise double, churned boolean")
    columns = ["visits", "noise"]
    scored = scoring.score_churn(scoring.train_churn(df, columns, str(tmp_path / "model")), df, threshold=0.2)
    check = {r.feature: r for r in scoring.moment_check(scored, columns).collect()}
    assert set(check) == {"(rows)", *columns} and all(r.agrees for r in check.values())
    assert check["(rows)"].actual == sum((i * 7919) % 11 < 4 for i in range(400))
    assert scored.filter("churn_predicted = 1").count() > 0
    other = scored.withColumn("churn_probability", scored.churn_probability * 0.9)
    assert not any(r.agrees for r in scoring.moment_check(other, columns).collect())
