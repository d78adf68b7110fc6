"""Time the catalogue at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

The tables are copied once into as many files as there are cores, so that no query is bound
to one task by a table in one file. The catalogue renders short lines from them, and its
times include that. Beside it, the lines are written as text once, and the four routes timed
on these dumps; and lines of real length are written, and each parser timed on them alone:
scan and parse, in MB/s. $BENCH_BLOCKS sets how many; intermediate files go to a
folder that is removed at the end.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from blockfee import operators as op  # noqa: E402
from blockfee import plans, sinks, sources, streaming  # noqa: E402
from blockfee.session import session  # noqa: E402
from catalogue import standin  # noqa: E402
from catalogue.queries import QUERIES  # noqa: E402

#: Queries that go through every order as one block line.
BLOCK_QUERIES = {
    "q01_fee_node_batch": "node_batch",
    "q03_fee_explorer_batch": "explorer_batch",
    "q22_stream_fee_node": "node_stream",
    "q23_stream_fee_explorer": "explorer_stream",
}


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


#: Tables that queries read, dealt out over files.
TABLES = ("orders", "lineitem", "events", "documents")


def spread_tables(spark: SparkSession, sf_dir: str, folder: str, files: int) -> str:
    """Copies of the tables in ``files`` files each."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{folder}/{name}.parquet")
    return folder


def route_rates(spark: SparkSession, sf_dir: str, folder: str, files: int, blocks: int) -> dict[str, int]:
    """Blocks a second through the four routes, from written dumps; best of three."""
    lines = {"node": standin.node_lines, "explorer": standin.explorer_lines}
    for name, render in lines.items():
        render(spark, sf_dir).select("value").repartition(files).write.text(f"{folder}/{name}")
    values = standin.coinbase(spark, sf_dir).drop("l_orderkey")
    values.write.parquet(f"{folder}/values")
    sinks.put_coinbase(values, f"{folder}/coinbase", 0, digits=1)
    known, reader = spark.read.parquet(f"{folder}/values"), sinks.coinbase_reader(spark, f"{folder}/coinbase")

    def stream(name: str, run: int) -> None:
        base = f"{folder}/{name}-stream-{run}"
        refused = f"{base}/refused"
        put = plans.put_node_fees(reader, f"{base}/t", refused) if name == "node" else plans.put_explorer_fees(f"{base}/t", refused)
        streaming.run_stream(sources.stream_lines(spark, f"{folder}/{name}", files), put, f"{base}/c", interval=None)

    routes = {
        "node_batch": lambda run: seconds(lambda: plans.node_fees(sources.read_lines(spark, f"{folder}/node"), known)),
        "explorer_batch": lambda run: seconds(lambda: plans.explorer_fees(sources.read_lines(spark, f"{folder}/explorer"))),
        "node_stream": lambda run: stream("node", run),
        "explorer_stream": lambda run: stream("explorer", run),
    }
    rates = {}
    for name, route in routes.items():
        times = []
        for run in range(3):
            start = time.perf_counter()
            route(run)
            times.append(time.perf_counter() - start)
        rates[name] = round(blocks / min(times))
    return rates


#: Transactions of a block of real length, about 33 kB of text.
TRANSACTIONS = 481


def write_long_lines(spark: SparkSession, path: str, blocks: int) -> None:
    ids = F.transform(
        F.sequence(F.lit(1), F.lit(TRANSACTIONS)),
        lambda i: F.concat(F.lit("u'"), F.sha2(F.concat_ws("-", "id", i), 256), F.lit("'")),
    )
    line = F.concat(
        F.lit("{u'hash': u'"), F.sha2(F.col("id").cast("string"), 256),
        F.lit("', u'confirmations': 1, u'size': 33000, u'bits': u'1b04864c', u'nonce': 7, u'tx': ["),
        F.array_join(ids, ", "),
        F.lit("], u'merkleroot': u'ab', u'height': "), F.col("id") + 210_000,
        F.lit(", u'version': 2, u'time': 1354116278, u'difficulty': Decimal('3438908.96015914'), "
              "u'chainwork': u'00ff', u'previousblockhash': u'aa', u'nextblockhash': None}"),
    )
    spark.range(0, blocks, 1, 16).select(line.alias("value")).write.text(path)


def long_line_rates(spark: SparkSession, folder: str, blocks: int) -> dict[str, float]:
    """MB of text per second through each parser, scan included; best of three."""
    path = f"{folder}/long-lines"
    write_long_lines(spark, path, blocks)
    size = sum(p.stat().st_size for p in Path(path).glob("part-*")) / 1e6
    parsers: dict[str, Callable[[DataFrame], DataFrame]] = {
        "named": lambda x: op.accepted(op.node_references(x)).select("height", "txid"),
        "positional": lambda x: op.accepted(op.node_references(x, "positional")).select("height", "txid"),
        "headers": lambda x: op.block_headers(op.accepted(op.node_blocks(x))),
        "edges": lambda x: op.tx_edges(op.accepted(op.node_blocks(x))),
    }
    lines = sources.read_lines(spark, path)
    return {
        name: round(size / min(seconds(lambda: parse(lines)) for _ in range(3)), 1) for name, parse in parsers.items()
    }


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="bench-") as folder:
        print(json.dumps(run(folder)))


def run(folder: str) -> dict:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = session(
        "blockfee-bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": folder,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    blocks = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    tables = spread_tables(spark, sf_dir, f"{folder}/tables", int(cpus))

    # Best of three rounds: the first ones also pay for warming up.
    timings = dict.fromkeys(names, float("inf"))
    for _ in range(3):
        for name in names:
            took = seconds(lambda: QUERIES[name](spark, tables))
            timings[name] = min(timings[name], round(took, 3))
            print(f"{name}: {took:.3f} s", file=sys.stderr)
    routes = route_rates(spark, tables, f"{folder}/dumps", int(cpus), blocks)
    rates = long_line_rates(spark, folder, int(os.environ.get("BENCH_BLOCKS", "8000")))
    spark.stop()

    return {
        "metric": "catalogue_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
        "cpus": int(cpus),
        "blocks": blocks,
        "blocks_per_sec": {
            label: round(blocks / timings[name])
            for name, label in BLOCK_QUERIES.items()
            if timings.get(name)
        },
        "written_dumps_blocks_per_sec": routes,
        "long_lines_mb_per_sec": rates,
    }


if __name__ == "__main__":
    main()
