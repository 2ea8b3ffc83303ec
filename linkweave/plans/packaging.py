"""Zip a result for handing in: sources and outputs, validated before anything is written."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from pathlib import Path

EXCLUDED_FOLDERS = {"__pycache__", ".git", ".venv", "venv", ".pytest_cache", "models", "spark-warehouse"}
EXCLUDED_SUFFIXES = {".pyc", ".pkl"}


class PackagingError(ValueError):
    """Something that the archive needs is missing or invalid."""


def source_files(folder: Path) -> Iterator[Path]:
    for path in sorted(folder.rglob("*")):
        if path.is_file() and path.suffix not in EXCLUDED_SUFFIXES and not EXCLUDED_FOLDERS & set(path.relative_to(folder).parts):
            yield path


def build_zip(target: str, code_dir: str, outputs: dict[str, str], required: tuple[str, ...] = (), check=None) -> str:
    """outputs: names in the archive -> local files. ``check`` returns (errors, warnings) and runs first."""
    code = Path(code_dir)
    missing = [p for p in (*outputs.values(), *(str(code / r) for r in required)) if not Path(p).exists()]
    if not code.is_dir() or missing:
        raise PackagingError(f"missing: {missing or code_dir}")
    if check is not None:
        errors, _ = check()
        if errors:
            raise PackagingError("; ".join(errors))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for path in source_files(code):
            if path.resolve() != Path(target).resolve():
                archive.write(path, f"code/{path.relative_to(code)}")
        for name, path in outputs.items():
            archive.write(path, name)
    return target


def main(argv: list[str] | None = None) -> int:
    import argparse

    parser = argparse.ArgumentParser(prog="linkweave-package", description="Zip code and outputs")
    parser.add_argument("target")
    parser.add_argument("--code-dir", default=".")
    parser.add_argument("--matching", default="output/matching_results.tsv")
    parser.add_argument("--candidates", default="output/candidate_pairs.tsv")
    parser.add_argument("--test-dir", help="validate against this split first")
    args = parser.parse_args(argv)
    check = None
    if args.test_dir:
        from pyspark.sql import SparkSession

        from linkweave.operators.validate import check_outputs

        spark = SparkSession.builder.appName("linkweave-package").getOrCreate()
        check = lambda: check_outputs(spark, args.matching, args.candidates, args.test_dir)
    print(build_zip(args.target, args.code_dir, {"output/matching_results.tsv": args.matching, "output/candidate_pairs.tsv": args.candidates}, check=check))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
