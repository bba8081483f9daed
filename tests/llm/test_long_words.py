"""Words whose sums of powers are equal by their build are different words."""

import os

from zonelake.llm import metric_join
from zonelake.llm.common import release, stage, staging


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_built_against_the_hash_do_not_link(spark):
    for n in (64, 1024, 4096):
        word = thue_morse(n)
        other = word.translate(str.maketrans("ab", "ba"))
        docs = spark.createDataFrame([(1, word), (2, other), (3, word.upper())], "doc_id long, text string")
        found = {r.doc_id: r.component_id for r in metric_join.near_duplicates(docs).collect()}
        assert found == {1: 1, 2: 2, 3: 1}


def test_folders_of_a_finished_block_go(spark):
    with staging(spark):
        gone = stage(spark.range(3), "gone")
    kept = stage(spark.range(3), "kept")
    path = lambda df: df.inputFiles()[0].removeprefix("file://")
    before = path(gone), path(kept)
    assert os.path.exists(before[0])
    with staging(spark):
        assert not os.path.exists(before[0]) and os.path.exists(before[1])
    release(spark)
