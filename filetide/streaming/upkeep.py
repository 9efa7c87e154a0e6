"""What runs beside ingest: lost jobs' numbers, exact rollups, compaction, removal of replaced files, expiry."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from filetide.operators.rollup import RollupSpec
from filetide.session import prepare
from filetide.storage import layout, numbers, retention, tables
from filetide.streaming.maintain import AS_INSERTED, EXACT, SPECS, maintain_rollups, refresh


def take_over(spark: SparkSession, root: str, mode: str | None = EXACT, specs: tuple[RollupSpec, ...] = SPECS,
              lease_seconds: float = numbers.LEASE_SECONDS) -> dict[str, list[int]]:
    """Settles the open numbers whose jobs have not been heard of for ``lease_seconds``: what is stored as a
    whole is finished, anything else is given up, so that it no longer holds back the others."""
    done: dict[str, list[int]] = {"finished": [], "given up": []}
    for mark in numbers.abandoned(spark, root, lease_seconds):
        if numbers.holds(spark, root, mark.number, mark.owner) and numbers.is_stored(spark, root, mark.number):
            if mode == AS_INSERTED:
                rows = layout.read_raw_parts(spark, root).filter(F.col("batch_id") == mark.number)
                maintain_rollups(rows, mark.number, root, mode, specs)
            if numbers.release(spark, root, mark.number):
                done["finished"].append(mark.number)
        elif numbers.give_up(spark, root, mark):
            done["given up"].append(mark.number)
    return done


def upkeep(spark: SparkSession, root: str, as_of, mode: str = EXACT, specs: tuple[RollupSpec, ...] = SPECS,
           raw_days: int = retention.RAW_DAYS, rollup_years: int = retention.ROLLUP_YEARS,
           lease_seconds: float = numbers.LEASE_SECONDS) -> dict[str, list[date] | list[int]]:
    """One round over the stored tables: the days each step changed, the numbers that were taken over, and
    those that are still open and so hold back the batches after them.

    Rollups come first, since they need the raw rows that expire last. Safe to stop at any point and
    to run again; run it from one place at a time.
    """
    prepare(spark)
    if mode not in (AS_INSERTED, EXACT):
        raise ValueError(f"mode is {AS_INSERTED!r} or {EXACT!r}, not {mode!r}")
    done = dict(take_over(spark, root, mode, specs, lease_seconds))
    done["held back"] = [m.number for m in numbers.open_marks(spark, root)]
    done["refreshed"] = refresh(spark, root, None, specs) if mode == EXACT else []
    done["compacted raw"] = tables.compact_raw(spark, root)
    for spec in specs:
        done[f"compacted {spec.name}"] = tables.compact_rollup(spark, root, spec)
        done[f"expired {spec.name}"] = retention.expire_rollup(spark, root, spec, as_of, rollup_years)
    layout.vacuum(spark, layout.table_path(root, tables.QUARANTINE), layout.RAW_DAY)
    done["expired raw"] = retention.expire_raw(spark, root, as_of, raw_days)
    return done
