"""Commands: ``run`` filters a folder of exports, ``archive`` and ``activate`` manage a lexicon folder."""

from __future__ import annotations

import argparse
import json
import logging
import sys
import time
import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake import config
from murmurlake.operators import filters, lexicon
from murmurlake.plans import pipeline, reports
from murmurlake.sources import files
from murmurlake.sources import messages as src


def read_decisions(spark: SparkSession, path: str | None) -> DataFrame | None:
    if not path:
        return None
    lines = spark.read.text(files.required(spark, path)).select(
        F.monotonically_increasing_id().alias("line_no"), F.from_json("value", "kind string, key string, decision string, reason string").alias("e")
    )
    return filters.latest_decisions(lines.select("line_no", "e.kind", F.col("e.key").alias("decision_key"), "e.decision", "e.reason"))


def read_archived(spark: SparkSession, folder: str) -> DataFrame:
    """An archive's own files, or the archive of a folder of lexicons where it has none."""
    if any(files.exists(spark, f"{folder.rstrip('/')}/{lexicon._file(k, '_archive')}") for k in lexicon.KINDS):
        return lexicon.read_archive(spark, folder)
    return lexicon.archive(lexicon.read_folder(spark, folder))


def read_audit(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """JSON lines of a run; a line that can't be read ends the command."""
    freq = "map<string,bigint>"
    rows = spark.read.option("mode", "FAILFAST").json(files.required(spark, folder))
    missing = [c for c in columns.split() if c not in rows.columns]
    if missing:
        raise ValueError(f"{folder}: without {', '.join(missing)}")
    return rows.withColumn("bucket_freq", F.from_json(F.to_json("bucket_freq"), freq))


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="murmurlake", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="filter exports into bucketed blocks")
    r.add_argument("--input", help="folder of exports; by default the settings file's")
    r.add_argument("--output", help="folder of runs; by default the settings file's")
    r.add_argument("--config", help="TOML over the preset; may name folders, with {writer_name} in them")
    r.add_argument("--writer-name", help="fills {writer_name} in the paths of the settings file")
    r.add_argument("--root", default=".", help="folder that relative paths of the settings file start from")
    r.add_argument("--preset", choices=("code", "tuned"), default="tuned")
    r.add_argument("--lexicons")
    r.add_argument("--archive")
    r.add_argument("--decisions")
    r.add_argument("--me-id", action="append", default=[])
    r.add_argument("--me-name", action="append", default=[])
    r.add_argument("--include-all-speakers", action="store_true")
    r.add_argument("--limit-files", type=int)
    r.add_argument("--max-messages", type=int)
    r.add_argument("--json-lines", action="store_true")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--mine-phrases", action="store_true", help="mine, whatever the settings say")
    r.add_argument("--skip-phrase-mining", action="store_true")
    r.add_argument("--update-lexicon", action="store_true", help="append mined candidates to phrase_candidates.jsonl of the lexicons")
    r.add_argument("--force-update-phrase-bank", action="store_true", help="append promoted phrases to phrase_bank.jsonl of the lexicons")
    r.add_argument("--debug", action="store_true", help="log the plans of the large outputs")
    a = sub.add_parser("archive", help="archive a lexicon folder")
    a.add_argument("--lexicons", required=True)
    a.add_argument("--output", required=True)
    a.add_argument("--force", action="store_true")
    g = sub.add_parser("activate", help="make the next active lexicon from an audit")
    g.add_argument("--lexicons", required=True)
    g.add_argument("--run", required=True, help="folder of a run with an audit")
    g.add_argument("--output", required=True)
    g.add_argument("--force", action="store_true", help="write; without it only counts are shown")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("murmurlake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.command == "archive":
        print(lexicon.write_archive(lexicon.read_folder(spark, args.lexicons), args.output, args.force))
        return 0
    if args.command == "activate":
        audited = read_audit(spark, f"{args.run}/lexicon_audit", "term suggested_status freq_total candidate_rate")
        mined = read_audit(spark, f"{args.run}/phrases", "phrase freq style_keyness")
        rows = lexicon.next_active(audited, read_archived(spark, args.lexicons), mined)
        print(json.dumps(lexicon.write_active(rows, args.output, dry_run=not args.force), ensure_ascii=False))
        return 0
    logging.basicConfig(level=logging.DEBUG if args.debug else logging.WARNING)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    started = time.time()
    try:
        tree = tomllib.loads(files.read_text(spark, args.config)) if args.config else {}
        s = config.from_mapping(tree, config.TUNED if args.preset == "tuned" else config.CODE_DEFAULTS)
        writer = args.writer_name if args.writer_name is not None else s.writer_name
        config.check(s.with_(writer_name=writer))
        named = config.paths(tree, writer, args.root)
    except (ValueError, tomllib.TOMLDecodeError) as e:
        print(e, file=sys.stderr)
        return 1
    folder, output = args.input or named.get("input"), args.output or named.get("output")
    if not folder or not output:
        print("which folders? give --input and --output, or a settings file that names them", file=sys.stderr)
        return 1
    if args.mine_phrases or args.skip_phrase_mining:
        s = s.with_(mining_enabled=not args.skip_phrase_mining)
    s = s.with_(writer_name=writer, update_candidates=s.update_candidates or args.update_lexicon, update_phrase_bank=s.update_phrase_bank or args.force_update_phrase_bank)
    ids, names = (*s.me_ids, *args.me_id), (*s.me_names, *args.me_name)
    if not ids and not names and not args.include_all_speakers:
        print("who is the target speaker? give --me-id or --me-name, or --include-all-speakers", file=sys.stderr)
        return 1
    rows, infos, warnings = src.read_exports(spark, folder, args.limit_files, args.json_lines)
    if args.max_messages:
        rows = rows.orderBy(*src.in_file_order(rows)).limit(args.max_messages)
    rows = pipeline.cut(src.owned_by_identity(rows, ids, names, args.include_all_speakers), "messages")
    lexicons = args.lexicons or named.get("lexicons")
    entries = lexicon.read_folder(spark, lexicons) if lexicons else spark.createDataFrame([], lexicon.SCHEMA)
    decisions = read_decisions(spark, args.decisions or named.get("decisions"))
    archive = args.archive or named.get("archive")
    archived = read_archived(spark, archive) if archive else None
    result = pipeline.run(rows, s, lexicon.word_lists(lexicon.active(entries)), decisions, archived)
    result.warnings = [f"{w['source_file']}: {w['warning']}" for w in warnings.limit(51).collect()]
    found, parsed = src.scan_folder(spark, folder, args.limit_files).count(), infos.count()
    if args.debug:
        logging.debug("%s", result.blocks._jdf.queryExecution().toString())
    if args.dry_run:
        print(json.dumps(pipeline.stats(result, found, parsed), ensure_ascii=False))
        return 0
    stats = reports.write_run(result, reports.run_folder(output), found, parsed, started)
    if lexicons and result.mined is not None and s.update_candidates:
        stats["new_candidates_appended"] = lexicon.append_candidates(result.mined, f"{lexicons.rstrip('/')}/phrase_candidates.jsonl")
    if lexicons and result.promoted and s.update_phrase_bank:
        lines = [json.dumps({"phrase": p, "label": "analysis_marker", "source": "phrase_mining_auto", "status": "active"}, ensure_ascii=False) for p in result.promoted]
        files.append_text(spark, f"{lexicons.rstrip('/')}/phrase_bank.jsonl", "".join(f"{x}\n" for x in lines))
    print(json.dumps(stats, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    sys.exit(main())
