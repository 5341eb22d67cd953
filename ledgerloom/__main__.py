"""python -m ledgerloom export | import | migrate | convert | verify | prune | version: the verbs on an inventory: Parquet (key, value), or a store's folder."""

from __future__ import annotations

import argparse
import json
import logging

import pyspark
from pyspark.sql import SparkSession

from ledgerloom import __version__
from ledgerloom.plans import conversion, history, report, snapshot
from ledgerloom.plans.progress import Progress
from ledgerloom.plans.staging import scratch, staged
from ledgerloom.sources import inputs, kv, records


def _hex(size: int | None = None):
    def parse(text: str) -> bytes:
        data = bytes.fromhex(text.removeprefix("0x"))
        if size is not None and len(data) != size:
            raise ValueError(f"{size} bytes are wanted")
        return data

    return parse


def _path(text: str) -> str:
    if not text.strip():
        raise ValueError("a path is empty")
    return text


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="ledgerloom", description=__doc__)
    out.add_argument("--verbose", action="store_true", help="tell of phases as they go on")
    verbs = out.add_subparsers(dest="verb", required=True)
    add = lambda name, *args: [verbs.choices[name].add_argument(a, **k) for a, k in args] if verbs.add_parser(name) else None
    need, may = {"required": True, "type": _path}, {"type": _path}
    source, scheme = ("--source", need), ("--scheme", {"choices": snapshot.SCHEMES, "default": "hash"})
    domain = ("--domain", {"type": lambda x: x.encode(), "help": "domain of the record chain"})
    token = [("--token", {"type": _hex(20)}), ("--witness", may), ("--code", may), ("--retain", may), ("--alloc", may), ("--audit", may), ("--cold", may), ("--extra", {"type": lambda x: x.encode(), "default": b""})]
    add("export", source, ("--out", need), ("--compression", {"choices": ["none", "zstd"], "default": "none"}), ("--streams", {"type": int, "default": 0, "help": "write so many streams at once instead of one"}), domain)
    add("import", ("--bundle", need), ("--out", need), scheme, domain)
    add("migrate", source, ("--out", need), scheme)
    add("convert", source, ("--out", need), scheme, *token)
    add("verify", ("--target", need), ("--bundle", may), ("--source", may), domain, *token)
    add("prune", source, ("--out", may), ("--genesis-root", {"type": _hex(32)}), ("--report", may), ("--compact", {"action": "store_true", "help": "write what stays sorted by key"}))
    add("version")
    return out


def head_of(spark: SparkSession, path: str) -> history.Head:
    return history.read_head(kv.point_reader(spark, path))


def options_of(a: argparse.Namespace) -> conversion.Options:
    if not (a.token and a.witness and a.code):
        raise ValueError("a conversion needs --token, --witness and --code")
    return conversion.Options(a.token, a.witness, a.code, a.retain, a.alloc, a.audit, a.cold, a.extra)


def run(spark: SparkSession, a: argparse.Namespace) -> dict:
    """What a verb found: the artifact's path with its report, or what was measured. A head that moves before the output appears ends it."""
    progress = Progress(spark, a.verb)
    with scratch(spark), progress.phase(a.verb):
        if a.verb == "import":
            inputs.outside(a.out, a.bundle)
            return {"artifact": a.out, "verification": snapshot.import_bundle(spark, a.bundle, a.out, a.scheme, a.domain)}
        if a.verb == "verify" and a.bundle:
            if a.source:
                raise ValueError("an artifact is verified against a bundle or against a source")
            return {"artifact": a.target, "verification": snapshot.verify_bundle(spark, a.bundle, a.target, a.domain)}
        if not a.source:
            raise ValueError("--source or --bundle is wanted")
        source, head = kv.read_kv(spark, a.source), head_of(spark, a.source)
        if kv.is_store(a.source):
            source = staged(source, "store")  # its newest entries are sorted out once

        def confirm() -> None:
            if head_of(spark, a.source) != head:
                raise ValueError("the head has moved")

        if a.verb == "verify":
            if snapshot.read_artifact(spark, a.target)["format"] == report.CONVERSION:
                found = conversion.verify(source, head, options_of(a), a.target, confirm)
            else:
                found = snapshot.verify_direct(source, head, a.target, confirm)
            return {"artifact": a.target, "verification": found}
        if a.out:
            inputs.outside(a.out, a.source, *(options_of(a).inputs().values() if a.verb == "convert" else ()))
        if a.verb == "export":
            return vars(snapshot.export(source, head, a.out, a.compression, a.domain or records.DOMAIN, confirm, a.streams))
        if a.verb == "migrate":
            return {"artifact": a.out, "verification": snapshot.migrate(source, head, a.out, a.scheme, confirm)}
        if a.verb == "convert":
            return {"artifact": a.out, "verification": conversion.migrate(source, head, options_of(a), a.out, a.scheme, confirm)}
        if a.compact and not a.out:
            raise ValueError("--compact wants --out")
        measures = snapshot.prune(source, head.state_root, a.out, a.genesis_root, confirm, a.compact)
        confirm()
        found = report.prune(head, measures, a.genesis_root, not a.out, a.compact)
        if a.report:
            report.write(spark, a.report, found)
            if report.read(spark, a.report) != found:
                raise ValueError("report differs after reading")
        return found


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    if a.verb == "version":
        print(f"ledgerloom {__version__}, pyspark {pyspark.__version__}")
        return
    if a.verbose:
        logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = SparkSession.builder.appName("ledgerloom").getOrCreate()
    print(json.dumps(run(spark, a), indent=1, sort_keys=True))


if __name__ == "__main__":
    main()
