import pytest

from cellpulse.llm import main_text


@pytest.mark.parametrize("html, text", [
    ("<svg class='i' viewBox='0 0 > 1'/><article><p>One<svg/> two<p>End</article>",
     "One two\nEnd"),
    ("<article><p>One <SVG width=\"1\" />two<p>End<svg><text>no</text></svg></article>",
     "One two\nEnd"),
    ("<article><p>One <svg><path d='m'/><text>no</text></svg><p>End</article>", "One\nEnd"),
    ("<article><p>As <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds<math/><p>End</article>",
     "As x=1 holds\nEnd"),
    ("<article><p>One<script src='x'/>var a;</script><p>End</article>", "One\nEnd"),
])
def test_foreign_elements(spark, html, text):
    blocks = [b[0] for b in main_text.blocks(html)]
    assert "\n".join(blocks) == text
    assert main_text.page_text(html, main_text.fit_tree(spark)) == text


def test_a_quote_opens_a_value_only_after_an_equals_sign(spark):
    words = " ".join(f"word{i}" for i in range(40))
    page = (f"<html><body><article><p class=x' >It's the first {words}.</p>"
            f"<p title='a > b'>It's the second {words}.</p><p data-a=\"1>{words}</p></article></body></html>")
    frame = spark.createDataFrame([(1, "u", page)], "page_id bigint, url string, html string")
    text = main_text.extract(frame, ["page_id", "url"]).first()["text"]
    assert text.split("\n")[:2] == [f"It's the first {words}.", f"It's the second {words}."]
