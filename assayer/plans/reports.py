"""Results to files for people: tables as one CSV file each, and the report, which is a few rows."""

from __future__ import annotations

import hashlib
from pathlib import Path

from ..sources.files import replace_whole
from ..sources.one_file import shown, write_csv  # noqa: F401

BLANK = "—"


def report_folder(results: Path, root: Path) -> Path:
    return results / f"{root.name}-{hashlib.sha256(str(root.resolve()).encode()).hexdigest()[:10]}"


def cell(value) -> str:
    return shown(value) or BLANK


def percent(value) -> str:
    return BLANK if value is None else f"{value:.1%}"


def table(header: list[str], rows: list[list[str]]) -> list[str]:
    return ["| " + " | ".join(r) + " |" for r in (header, ["---"] * len(header), *rows)]


NOTES = """\
- Rubric points: at most 5 for each task. Win rate: share of tasks on which the judge preferred the product to the expert; half a point for a tie.
- A product gets totals and a rank once all its tasks are graded or marked as failed; a failed task is worth nothing.
- `—` stands for what isn't known. A 0 was entered or earned.
- The judge reads extracted text: layout, images, charts and live formulas need a person's eye.
- Seconds and tokens are those entered for the product; `scores.csv` has costs of judging, notes and digests."""


def markdown(path: Path, board: list, scores: list, task_count: int, modes: tuple[str, ...], model: str) -> None:
    """The report for people: what was judged by whom, the ranking, every task, how to read them."""
    best = {"rubric": f"rubric points of {5 * task_count}", "pairwise": "win rate against the expert"}
    ranking = [
        {
            "rank": cell(r["rank"]), "product": r["product"], "graded": f"{r['scored_tasks']} of {task_count}", best["rubric"]: cell(r["rubric_total"]),
            best["pairwise"]: percent(r["pairwise_win_rate"]), "seconds": cell(r["elapsed_seconds_total"]), "tokens": cell(r["tokens_total"]),
        }
        for r in board
    ]
    each = [{c: cell(r[c]) for c in ("product", "task", "status", "rubric_score", "pairwise_score", "elapsed_seconds", "tokens")} for r in scores]
    sections = [("Ranking", ranking), ("Every task", each)]
    text = [f"# {len(board)} products on {task_count} tasks", f"Judged by `{model}` ({' and '.join(best[m] for m in modes)}; ranked by the first)."]
    for title, rows in sections:
        text += [f"## {title}", "\n".join(table(list(rows[0]), [list(r.values()) for r in rows])) if rows else "Nothing."]
    text += ["## How to read this", NOTES]
    path.parent.mkdir(parents=True, exist_ok=True)
    replace_whole(path, "\n\n".join(text) + "\n")
