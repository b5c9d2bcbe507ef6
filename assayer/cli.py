"""python -m assayer.cli prepare|run|flat: exit code 0, or 1 if a row is an error or nothing could be run."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .plans import flat, packet
from .sources import bank
from .sources.judge import ChatJudge, DeterministicJudge, Judge, JudgeError, credential

#: What a user can put right; anything else is a fault of the program and shows its trace.
FORESEEN = (JudgeError, OSError, ValueError, KeyError)
MODES = {"rubric": ("rubric",), "pairwise": ("pairwise",), "both": ("rubric", "pairwise")}


def _count(text: str) -> int:
    if not text.isdecimal() or int(text) == 0:
        raise argparse.ArgumentTypeError("a number of tasks, 1 or more")
    return int(text)


def _names(text: str) -> list[str]:
    found = [x.strip() for x in text.split(",") if x.strip()]
    if not found or len(set(found)) < len(found):
        raise argparse.ArgumentTypeError("different names, comma-separated")
    return found


def _tasks(a: argparse.Namespace, spark: SparkSession) -> DataFrame:
    return bank.tasks(bank.read_task_ids(spark, a.ids), bank.read_bank(spark, a.bank)).cache()


def _judge(a: argparse.Namespace) -> Judge:
    return ChatJudge(a.judge, a.model, a.provider, credential("JUDGE_API_KEY", a.data / "judge_key")) if a.judge else DeterministicJudge(a.model)


def _experts(a: argparse.Namespace, spark: SparkSession, tasks: DataFrame, modes: tuple[str, ...]) -> DataFrame | None:
    return packet.expert_texts(spark, tasks, a.data / "experts") if "pairwise" in modes else None


def prepare(a: argparse.Namespace, spark: SparkSession) -> int:
    packet.prepare(spark, _tasks(a, spark), a.root, a.products, a.data / "references")
    return 0


def run(a: argparse.Namespace, spark: SparkSession) -> int:
    tasks, modes = _tasks(a, spark), MODES[a.mode]
    _, scores = packet.evaluate(spark, tasks, a.root, a.products, _judge(a), a.results, modes, a.limit, _experts(a, spark, tasks, modes))
    return 1 if "error" in {r["status"] for r in scores} else 0


def run_flat(a: argparse.Namespace, spark: SparkSession) -> int:
    tasks = _tasks(a, spark)
    value, cost = flat.run(spark, tasks, a.root, a.product, a.mode, _judge(a), a.results, a.limit, _experts(a, spark, tasks, (a.mode,)), a.seed)
    print(f"{a.product} {a.mode}: {value:.3f}, new verdicts cost {cost:.3f}")
    return 0


def _parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--bank", default="data/bank.parquet")
    common.add_argument("--ids", default="data/task_ids.txt")
    common.add_argument("--root", type=Path, default=Path("tasks"))
    common.add_argument("--data", type=Path, default=Path("data"))
    judged = argparse.ArgumentParser(add_help=False)
    judged.add_argument("--judge", default="", help="address of a chat-completions endpoint; without one verdicts come from a digest")
    judged.add_argument("--model", default="digest")
    judged.add_argument("--provider", default="")
    judged.add_argument("--limit", type=_count)
    judged.add_argument("--results", type=Path, default=Path("results"))
    top = argparse.ArgumentParser(description=__doc__)
    commands = top.add_subparsers(required=True)

    def command(name: str, do: Callable, *parents: argparse.ArgumentParser) -> argparse.ArgumentParser:
        p = commands.add_parser(name, parents=[common, *parents])
        p.set_defaults(do=do)
        return p

    command("prepare", prepare).add_argument("--products", type=_names, required=True, help="in report order")
    packets = command("run", run, judged)
    packets.add_argument("--products", type=_names, required=True, help="in report order")
    packets.add_argument("--mode", choices=MODES, default="both")
    one = command("flat", run_flat, judged)
    one.add_argument("--product", required=True)
    one.add_argument("--mode", choices=("rubric", "pairwise"), required=True)
    one.add_argument("--seed", type=int, default=0)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    try:
        return a.do(a, spark or SparkSession.builder.getOrCreate())
    except FORESEEN as e:
        told = type(e) is not KeyError and not isinstance(e, OSError)
        print("not run:", e if told else type(e).__name__, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
