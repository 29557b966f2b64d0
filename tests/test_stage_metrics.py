from __future__ import annotations

import pytest

from weftline.operators import stage_metrics as sm

COLUMNS = sorted(
    {*sm.MINUTE_COLUMNS, *sm.MB_COLUMNS, *sm.REPORT_ORDER, *sm.SUMMED}
    | {"submissionTime", "completionTime"}
)
GB = 1024**3

# Two stages in which the processor and the loading of the task take most of the time.
REPORTED = [
    dict(stageId=0, stageDuration=4100, executorRunTime=2000, executorCpuTime=1900, jvmGCTime=60,
         executorDeserializeTime=900, numTasks=3, recordsRead=40, bytesRead=5120,
         submissionTime=100, completionTime=4200),
    dict(stageId=1, stageDuration=900, executorRunTime=400, executorCpuTime=350, jvmGCTime=8,
         executorDeserializeTime=240, numTasks=2, recordsRead=12, bytesRead=2048,
         submissionTime=4300, completionTime=5200),
]


def _frame(spark, stages):
    names = ["stageId", *COLUMNS]
    data = [tuple(stage.get(name, 0) for name in names) for stage in stages]
    return spark.createDataFrame(data, ", ".join(f"{name} BIGINT" for name in names))


FLAGS = (
    "is_cpu_bound",
    "is_memory_bound",
    "is_network_bound",
    "is_spill",
    "is_deserialize_heavy",
    "is_shuffle",
    "is_serialization",
    "is_storage",
)


def test_flags_of_the_reported_stages(spark):
    for row in sm.classify_stages(_frame(spark, REPORTED)).collect():
        raised = {flag for flag in FLAGS if row[flag]}
        assert raised == {"is_cpu_bound", "is_deserialize_heavy"}


@pytest.mark.parametrize(
    ("flag", "at", "over"),
    [
        ("is_cpu_bound", dict(executorRunTime=100, executorCpuTime=80), dict(executorCpuTime=81)),
        ("is_memory_bound", dict(executorRunTime=100, jvmGCTime=10), dict(jvmGCTime=11)),
        ("is_network_bound", dict(stageDuration=100, shuffleWriteTime=50), dict(shuffleFetchWaitTime=1)),
        ("is_spill", dict(), dict(memoryBytesSpilled=1)),
        (
            "is_deserialize_heavy",
            dict(executorRunTime=100, executorDeserializeTime=20),
            dict(executorDeserializeTime=21),
        ),
        ("is_shuffle", dict(shuffleWriteTime=1000), dict(shuffleFetchWaitTime=1)),
        (
            "is_serialization",
            dict(stageDuration=100, resultSerializationTime=10),
            dict(resultSerializationTime=11),
        ),
        ("is_storage", dict(peakExecutionMemory=GB), dict(peakExecutionMemory=GB + 1)),
    ],
)
def test_flags_at_and_over_their_limit(spark, flag, at, over):
    stages = [dict(stageId=0, **at), dict(stageId=1, **(at | over))]
    found = sm.classify_stages(_frame(spark, stages)).orderBy("stageId").collect()
    assert [row[flag] for row in found] == [False, True]


def test_a_stage_without_run_time_raises_no_share_flag(spark):
    row = sm.classify_stages(_frame(spark, [dict(stageId=0, executorCpuTime=5)])).first()
    assert not any(row[flag] for flag in FLAGS)


def test_slow_stages(spark, rows):
    stages = [
        dict(stageId=1, executorRunTime=100_000, jvmGCTime=5000, shuffleWriteTime=1000),
        dict(stageId=2, executorRunTime=100_001, jvmGCTime=5001),
        dict(stageId=3, shuffleFetchWaitTime=1001),
    ]
    found = rows(sm.flag_slow_stages(_frame(spark, stages)))
    assert found == [(2, "high_exec"), (2, "high_gc"), (3, "high_shuffle")]


def test_units_and_report_order(spark):
    stages = [
        dict(stageId=1, executorRunTime=60_000, bytesRead=1024 * 1024),
        dict(stageId=2, executorRunTime=90_000, bytesRead=512 * 1024),
    ]
    report = sm.stage_report(_frame(spark, stages)).collect()
    assert [r.stageId for r in report] == [2, 1]
    assert [r.executorRunTime_minutes for r in report] == [1.5, 1.0]
    assert [r.bytesRead_MBs for r in report] == [0.5, 1.0]


def test_summary_of_the_reported_job(spark):
    row = sm.summarize_metrics(_frame(spark, REPORTED)).first()
    assert (row.numStages, row.numTasks, row.recordsRead) == (2, 5, 52)
    assert (row.elapsedTime_seconds, row.elapsedTime_minutes) == (5.1, 0.085)
    assert (row.executorRunTime_seconds, row.executorCpuTime_seconds) == (2.4, 2.25)
    assert row.jvmGCTime_minutes == pytest.approx(0.068 / 60)
    assert row.bytesRead_MBs == 7 / 1024
