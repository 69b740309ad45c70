from __future__ import annotations


def rows(df, *columns):
    """The rows, sorted, as tuples of some columns."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def nodes(spark, job):
    """The names of the plan nodes that job() runs, over all its queries, and its result."""
    store = spark._jsparkSession.sharedState().statusStore()
    wait = spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty
    wait()
    before = {store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())}
    result = job()
    wait()
    done = store.executionsList()
    new = [x.executionId() for x in (done.apply(i) for i in range(done.size())) if x.executionId() not in before]
    graphs = [store.planGraph(i).allNodes() for i in new]
    return [g.apply(i).name() + " " + g.apply(i).desc() for g in graphs for i in range(g.size())], result


def records_by_task(spark, job):
    """For each stage that job() runs and that reads a shuffle: the records that each of its tasks reads."""
    sc = spark.sparkContext
    store, wait = sc._jsc.sc().statusStore(), sc._jsc.sc().listenerBus().waitUntilEmpty
    stages = lambda: store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    wait()
    before = {stages().apply(i).stageId() for i in range(stages().size())}
    job()
    wait()
    out, done = {}, stages()
    for s in (done.apply(i) for i in range(done.size())):
        if s.stageId() not in before and s.shuffleReadRecords():
            tasks = store.taskList(s.stageId(), s.attemptId(), 100_000)
            read = (tasks.apply(i).taskMetrics() for i in range(tasks.size()))
            out[s.stageId()] = sorted(m.get().shuffleReadMetrics().recordsRead() for m in read if m.isDefined())
    return out
