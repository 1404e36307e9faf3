"""Rows that take long are dealt over the cores, and a page is parsed once."""

from weir.functions import html
from weir.plans import more_queries
from weir.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_pages_and_fetches_are_dealt(spark):
    cores = spark.sparkContext.defaultParallelism
    for df in (more_queries.challenge_pages(spark, SF), QUERIES["NET-04"](spark, SF)):
        assert df.rdd.getNumPartitions() == 4 * cores


def test_a_page_is_parsed_once_and_after_it_is_dealt(spark):
    for name in ("FN-11", "FN-16"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1 and plan.index("ArrowEvalPython") < plan.index("Repartition")


def test_nodes_by_tag_are_those_of_a_walk():
    page = "<p>a<img src=x>b<br/><p>c<ul><li>1<li><a href=z>2</a><svg/><use/></ul></div><tr><td>x<td>y<tr><td><table><tr><td>q"
    tree = html.parse(page)
    for tag in {n.tag for n in tree.walk()} | {"none"}:
        assert tree.all(tag) == [n for n in tree.walk() if n.tag == tag]
