from pyspark.sql import functions as F

from streamscreen.llm import near_duplicates
from streamscreen.llm.components import components
from tests.conftest import rows


def test_a_large_group_is_one_link_a_member(spark, monkeypatch):
    # 300 members share the smallest ones of ten buckets; two of these are linked to others again.
    edges = [(a, b) for a in range(100, 400) for b in range(10)] + [(9, 3), (500, 420), (420, 410), (501, 410), (501, 2)]
    candidates = spark.createDataFrame(edges, "a bigint, b bigint")
    expected = rows(components(candidates))
    seen = []

    def counted(links):
        seen.append(links.count())
        return components(links)

    monkeypatch.setattr(near_duplicates, "components", counted)
    assert rows(near_duplicates._groups(candidates)) == expected
    assert seen and seen[0] < 20
    assert rows(near_duplicates._groups(candidates.where(F.lit(False)))) == []
