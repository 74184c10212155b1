"""The line model learns from whole documents."""
from crmflow.llm import line_labels


def test_lines_at_the_end_are_seen(spark):
    docs = spark.createDataFrame([(1, "\n".join(f"line {i} of a long text" for i in range(500)) + "\nline 3 of a long text")], "doc_id long, text string")
    [(x, y)] = line_labels.training_lines(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), 10)
    assert len(x) == len(y) == 501 and y[-1] == 1 and not y[:-1].any()
