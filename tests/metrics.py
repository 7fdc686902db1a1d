"""Rows that the nodes of the last query put out, from Spark's own metrics."""

from __future__ import annotations

import time


def rows_out(spark, run) -> list[tuple[str, str, int]]:
    """(node, description, rows) of every node that counts its rows, of the query that ``run`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for _ in range(50):
        executions = store.executionsList()
        if store.executionsCount() > before and executions.apply(executions.size() - 1).completionTime().isDefined():
            break
        time.sleep(0.1)
    execution = store.executionsList().apply(store.executionsList().size() - 1).executionId()
    values = store.executionMetrics(execution)
    nodes = store.planGraph(execution).allNodes()
    found = []
    for i in range(nodes.size()):
        node = nodes.apply(i)
        for k in range(node.metrics().size()):
            metric = node.metrics().apply(k)
            if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                found.append((node.name(), node.desc(), int(values.apply(metric.accumulatorId()).replace(",", ""))))
    return found
