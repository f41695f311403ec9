"""What workers keep from task to task, and the size of the pipeline's Arrow batches."""

from pyspark import cloudpickle

import corpus_pipeline
from cinderlake.llm import common, packing, quality
from cinderlake.llm.common import ARROW_ROWS, kept, released


def test_what_is_kept_goes_with_the_first_task_of_another_step():
    made = []

    def use(batches):
        for b in batches:
            yield kept("table", lambda: made.append(b) or len(made))

    assert list(released(use, keeps=True)([1, 2])) == [1, 1]
    assert list(released(use, keeps=True)([3])) == [1]
    assert list(released(lambda batches: (len(common._kept) for _ in batches))([4])) == [0]
    assert list(released(use, keeps=True)([5])) == [2]
    list(released(iter)([6]))
    assert made == [1, 5]


def test_what_is_kept_goes_in_a_worker_too():
    assert kept("table", lambda: 1) == 1
    keeping, other = (cloudpickle.loads(cloudpickle.dumps(released(iter, keeps=k))) for k in (True, False))
    assert list(keeping([7])) == [7] and common._kept == {"table": 1}
    assert list(other([8])) == [8] and not common._kept


def test_a_tokenizer_is_kept_for_packing_only():
    make = packing.word_tokenizer(corpus_pipeline.tokenizer_path("word_bpe_49k.json"))
    first = make()
    assert make() is first
    list(released(iter)([]))
    assert make() is not first
    list(released(iter)([]))


def test_stages_of_the_pipeline_take_short_batches(spark, monkeypatch):
    before = spark.conf.get(ARROW_ROWS)
    try:
        spark.conf.set(ARROW_ROWS, "10000")
        monkeypatch.setattr(quality, "fit", lambda *_: None)
        monkeypatch.setattr(quality, "keep_good", lambda docs, *_: docs)
        corpus_pipeline.keep_quality(spark, None, "/root/testdata/sf0.001")
        assert int(spark.conf.get(ARROW_ROWS)) == 500
    finally:
        spark.conf.set(ARROW_ROWS, before)
