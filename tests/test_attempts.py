"""Tasks that die and are made again: what their first attempts sent is in no counter.

Local sessions give every task one attempt unless their master says otherwise, so this
one runs in a process of its own.
"""

import json
import os
import subprocess
import sys

SCRIPT = r'''
import json, os, sys
sys.path[:0] = [sys.argv[1], os.path.join(sys.argv[1], "tests")]
from pyspark import TaskContext, cloudpickle
from pyspark.sql import SparkSession
import executors
from graphload.operators.delivery import (
    DeliveryOptions, reload, save_failures, write_batches)
from graphload.operators.statements import render_items, statement_frame
from graphload.operators.stats import load_stats
from graphload.sources import read_statements
from graphload.spec import GraphTarget, Label, VertexSpec

cloudpickle.register_pickle_by_value(executors)
folder = sys.argv[2]
spark = (SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", folder + "/shared").config("spark.driver.memory", "1g")
         .getOrCreate())
spark.sparkContext.setLogLevel("OFF")
graph = GraphTarget(4, "INT", 8, {"person": Label.of("vertex", {"name": "STRING"}, 1)})
spec = VertexSpec("person", "id", ("name",))
rows = spark.range(0, 400, 1, 4).selectExpr("id", "concat('n', id) AS name")
items = render_items(rows, spec, graph)


class Dying(executors.Recorder):
    """Refuses every tenth row; its process dies in the first attempt at two of the tasks."""

    def execute(self, statement):
        done = super().execute(statement)
        task = TaskContext.get()
        if task.attemptNumber() == 0 and task.partitionId() in (1, 3) and '"n' in statement and (
                "60: " in statement):
            os._exit(1)
        return done


log = folder + "/log"
results = write_batches(items, "person", statement_frame(spec),
                        lambda: Dying(log, ["5: "]), DeliveryOptions(batch=7, retry=0))
save_failures(results, folder + "/dead", "first")
total = load_stats(results).filter("entity = 'person'").first()
dead = [r.statement for r in read_statements(spark, folder + "/dead").collect()]
print(json.dumps({"sent": total.record_success, "failed": total.record_failure,
                  "batches": total.batch_success + total.batch_failure, "dead": dead,
                  "heard": executors.recorded(log)}))
spark.stop()
'''


def test_attempts_that_were_thrown_away_are_not_counted(tmp_path):
    os.mkdir(tmp_path / "log")
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT, home, str(tmp_path)], text=True,
                          capture_output=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    said = json.loads(done.stdout.strip().splitlines()[-1])
    refused = [i for i in range(400) if i % 10 == 5]
    # the executors heard the rows of the dead attempts twice
    heard = [line for line in said["heard"] if '100: ("n100")' in line]
    assert len(heard) >= 2
    # counters and dead letters have every row once
    assert (said["sent"], said["failed"]) == (400 - len(refused), len(refused))
    assert said["batches"] == 4 * 15
    assert sorted(said["dead"]) == sorted(
        f'INSERT VERTEX `person`(`name`) VALUES {i}: ("n{i}")' for i in refused)
