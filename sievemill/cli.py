"""Command line of a run over captured data."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

LEAST_DELAY_MS = 500


def _day(text: str) -> str:
    try:
        if len(text) != 10:
            raise ValueError
        return dt.date.fromisoformat(text).isoformat()
    except ValueError:
        raise argparse.ArgumentTypeError(f"{text!r} is no date YYYY-MM-DD") from None


def _positive(text: str) -> int:
    if not text.isdigit() or int(text) < 1:
        raise argparse.ArgumentTypeError(f"{text!r} is no positive whole number")
    return int(text)


def parse_args(argv: list[str], today: dt.date | None = None) -> argparse.Namespace:
    """Options of a run; the range is yesterday in UTC by default. Bad options end with code 2."""
    p = argparse.ArgumentParser(prog="sievemill", description="Cover, record and reconcile a capped source from captured data.", allow_abbrev=False)
    p.add_argument("--from", dest="start", type=_day)
    p.add_argument("--to", dest="end", type=_day)
    p.add_argument("--max-requests", type=_positive, default=40)
    p.add_argument("--max-cases", type=_positive, default=3)
    p.add_argument("--delay-ms", type=_positive, default=1500)
    p.add_argument("--retry-failed", action="store_true")
    p.add_argument("--data-dir", default="data")
    p.add_argument("--pdf-dir", default="pdfs")
    p.add_argument("--unbounded", action="store_true")
    args = p.parse_args(argv)
    today = today or dt.datetime.now(dt.UTC).date()
    args.start = args.start or args.end or (today - dt.timedelta(days=1)).isoformat()
    args.end = args.end or args.start
    if args.start > args.end:
        p.error("--from must not be after --to")
    if args.delay_ms < LEAST_DELAY_MS:
        p.error(f"--delay-ms must be at least {LEAST_DELAY_MS}")
    if args.unbounded:
        args.max_requests = args.max_cases = None
    return args


#: Labels of the summary's lines where they aren't the counter's name.
LABELS = {"retries": "429 retries"}


def summary_lines(row: dict) -> list[str]:
    """One line per counter in a fixed order."""
    from sievemill.plans.collection import SUMMARY

    shown = {**row, "stopped_by": row.get("stopped_by") or "(ran to completion)"}
    return ["--- run summary ---", *(f"{LABELS.get(k, k.replace('_', ' '))}: {shown[k]}" for k in SUMMARY if k in shown)]


def hint(row: dict) -> str | None:
    """What to say of a run of one window that lists nothing."""
    if row["windows"] == 1 and row["cases_listed"] == 0:
        return "hint: one window and no cases listed; the day may be a weekend or a holiday, try another range"
    return None


def main(argv: list[str] | None = None) -> int:
    """Run over the captured tables of a data folder, or try its failures again, and print what was done."""
    from pyspark.sql import functions as F

    from sievemill.functions.scalars import range_label
    from sievemill.plans.collection import event_line
    from sievemill.plans.job import Job
    from sievemill.session import build_session, ship
    from sievemill.sources.store import Store

    args = parse_args(sys.argv[1:] if argv is None else argv)
    print(f"range: {args.start}..{args.end}")
    print("limits: none" if args.unbounded else f"limits: {args.max_requests} requests, {args.max_cases} cases")
    spark = ship(build_session())
    job = Job(spark, Store(spark, f"{args.data_dir}/store"), f"{args.data_dir}/captured")
    batch = job.next_batch()
    if args.retry_failed:
        summary = job.retry(batch)
    else:
        log, summary = job.run(batch, args.start, args.end, args.max_requests, args.max_cases)
        label = F.coalesce(F.col("number"), range_label(F.col("from_day"), F.col("to_day"), F.col("class_id"), F.lit(None).cast("string")))
        lines = log.where("type <> 'resumed'").withColumns({"label": label, "message": F.col("reason"), "shown": F.col("rows")})
        for row in lines.orderBy("path", "stage", "ord", "number", "doc").select(event_line().alias("line")).toLocalIterator():
            print(row["line"])
    print("\n".join(summary_lines(summary)))
    if not args.retry_failed and (said := hint(summary)):
        print(said)
    return 0


if __name__ == "__main__":
    sys.exit(main())
