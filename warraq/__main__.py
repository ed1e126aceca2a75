"""python -m warraq FOLDER COMMAND [ARGUMENT] [--sources A,B] [--budget N] [--paras A-B] [--limit N] [--offset N] [--any] [--events] [--skip-verse]

Commands: verse S[:A], intro S, verse-coverage [S], toc SEG, text SEG, event NAME, events, person NAME|NUMBER, year N, search WORDS,
coverage, info, entries BOOK:NUMBERS, find WORDS, headings WORDS. Prints one JSON object a row. Ends with 2 for a question that makes no
sense, 3 for a corpus that isn't there, 0 otherwise: what isn't found is a row that says so.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from warraq.plans.api import Corpus, CorpusMissing, InputError
from warraq.sources.sinks import as_json


#: Options and the commands they belong to.
BELONGS = {
    "sources": ("verse", "intro", "event", "find"), "budget": ("verse", "intro", "event", "entries"), "paras": ("text",), "limit": ("find", "headings"), "offset": ("entries",),
    "any": ("find",), "events": ("toc", "text"), "skip_verse": ("text",),
}
WITHOUT_ARGUMENT, ARGUMENT_OPTIONAL = ("events", "coverage", "info"), ("verse-coverage",)


def check(a: argparse.Namespace) -> None:
    """Q12, Q17: an option that its command doesn't know, a missing or a needless argument is an error."""
    for option, commands in BELONGS.items():
        if getattr(a, option) not in (None, False) and a.command not in commands:
            raise InputError(f"--{option.replace('_', '-')} goes with {', '.join(commands)}")
    if a.command in WITHOUT_ARGUMENT and a.argument is not None:
        raise InputError(f"{a.command} takes no argument")
    if a.command not in (*WITHOUT_ARGUMENT, *ARGUMENT_OPTIONAL) and not (a.argument or "").strip():
        raise InputError(f"{a.command} needs an argument")


def answer(c: Corpus, a: argparse.Namespace):
    x, budget, limit = a.argument or "", a.budget or 0, 10 if a.limit is None else a.limit
    number = lambda: int(x) if x.strip().isdigit() else (_ for _ in ()).throw(InputError(f"no number: {x}"))
    return {
        "verse": lambda: c.verse(x, a.sources, budget), "intro": lambda: c.intro(number(), a.sources, budget),
        "verse-coverage": lambda: c.verse_coverage(number() if x else None), "toc": lambda: c.toc([number()], a.events),
        "text": lambda: c.text(number(), a.events, a.paras, a.skip_verse), "event": lambda: c.event(x, a.sources, budget), "events": c.events,
        "person": lambda: c.person(x), "year": lambda: c.year(number()), "search": lambda: c.search(x), "coverage": c.coverage, "info": c.info,
        "entries": lambda: c.entries_by_number(x, a.offset or 0, budget), "find": lambda: c.full_text(x, a.sources, a.any, limit), "headings": lambda: c.headings(x, limit),
    }[a.command]()


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="warraq", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("folder")
    p.add_argument("command", choices=["verse", "intro", "verse-coverage", "toc", "text", "event", "events", "person", "year", "search", "coverage", "info", "entries", "find", "headings"])
    p.add_argument("argument", nargs="?")
    p.add_argument("--sources")
    p.add_argument("--budget", type=int)
    p.add_argument("--offset", type=int)
    p.add_argument("--paras")
    p.add_argument("--limit", type=int)
    for flag in ("--any", "--events", "--skip-verse"):
        p.add_argument(flag, action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        check(a)
        for row in as_json(answer(Corpus(spark, a.folder), a)).toLocalIterator():
            print(row.json)
    except InputError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    except CorpusMissing as e:
        print(f"not there: {e}", file=sys.stderr)
        return 3
    return 0


if __name__ == "__main__":
    sys.exit(main())
