"""Pages without telling names, both ways of reading the network, and columns of clashing names."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import html_blocks

SENTENCES = ["The river rises in the northern hills and runs for two hundred miles to the sea.", "Its lower course was made fit for barges more than three centuries ago.", "Most of the old locks were rebuilt when the railway came to the valley.", "Today the towpath is used by walkers, and the barges carry visitors only."]
BAR = "".join(f'<a href="/{x}">{x.title()}</a> ' for x in ("home", "news", "sport", "travel", "contact"))
LIST = "<ul>" + "".join(f'<li><a href="/{x}">{x.title()} pages</a></li>' for x in ("home", "news", "sport", "travel")) + "</ul>"
BODY = "".join(f"<p>{x}</p>" for x in SENTENCES)
LAYOUTS = {
    "article": f"<nav>{BAR}</nav><article>{BODY}</article><footer>All rights reserved</footer>",
    "main": f"<header>{LIST}</header><main>{BODY}</main>",
    "named": f'<div class="menu">{LIST}</div><div class="post-content">{BODY}</div><div class="footer">Contact us</div>',
    "unnamed": f"<div>{BAR}</div><div>{BODY}</div>",
    "unnamed, list": f"{LIST}<div>{BODY}</div>",
    "unnamed, nested": f"<div>{LIST}</div><div><div>{BODY}</div></div><div>{BAR}</div>",
    "unknown": f'<div class="xq">{BAR}</div><div class="zorp">{BODY}</div>',
    "bare": f"{BODY}",
}


@pytest.fixture(scope="module")
def labeller(spark):
    return html_blocks.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(spark, labeller, layout):
    page = f"<html><head><title>T</title></head><body>{LAYOUTS[layout]}</body></html>"
    frame = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert html_blocks.extract(frame, labeller).first().text == "\n".join(SENTENCES)


def test_given_pages_give_their_articles(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    right = total = 0
    for r in pages.collect():
        blocks = html_blocks.blocks_of(r.html or "")
        chances = labeller.label([blocks], html_blocks.Encoder())[0]
        right += sum((p >= 0.5) == html_blocks.weak_label(b) for b, p in zip(blocks, chances, strict=True))
        total += len(blocks)
    assert right >= 0.999 * total


def test_labels_are_those_of_the_forward_pass(labeller):
    pages = [html_blocks.blocks_of(f"<body>{x}</body>") for x in (*LAYOUTS.values(), "", "one")]
    got = labeller.label(pages, html_blocks.Encoder())
    for blocks, chances in zip(pages, got, strict=True):
        if blocks:
            x, mask = html_blocks.padded([html_blocks.Encoder()(blocks)])
            assert chances == pytest.approx(labeller.forward(x, mask)[2][0], abs=1e-4)
        else:
            assert not len(chances)


def test_kept_columns_of_clashing_names(spark, labeller):
    frame = spark.createDataFrame([(1, LAYOUTS["article"]), (2, None)], "page_id long, html string")
    frame = frame.withColumns({c: F.lit(k) for k, c in enumerate(("text", "id", "_html", "n_blocks", "a.b"))})
    got = html_blocks.extract(frame, labeller, keep=("text", "id", "_html", "n_blocks", "a.b")).orderBy("id_").collect()
    assert got[0].asDict().keys() == {"id_", "text", "id", "_html", "n_blocks", "a.b", "text_", "n_blocks_", "n_main"}
    assert [r.id_ for r in got] == [1, 2] and got[0].text == 0 and got[0].text_ == "\n".join(SENTENCES) and got[1].text_ == ""
    assert np.isclose(got[0].n_main, len(SENTENCES))
