"""Files in, files out: sources, writers, experiments, training, prediction, packaging."""

import zipfile

import pytest

from linkweave.operators import validate as V
from linkweave.plans import experiments as E
from linkweave.plans import packaging, pipeline
from linkweave.sources import tables as T

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_tsv_keeps_text_as_it_is(spark, tmp_path):
    path = write(tmp_path / "a.tsv", HEAD + 'S1-1\t"O""Brien"\t\tNA\nS1-2\t  None \tx, y\tIN\n')
    rows = T.read_tsv(spark, path, columns=T.ENTITY_COLUMNS).orderBy("entity_id").collect()
    assert tuple(rows[0]) == ("S1-1", 'O"Brien', "", "NA") and rows[1].business_name == "  None "
    with pytest.raises(T.SourceError):
        T.read_tsv(spark, str(tmp_path / "none.tsv"))
    with pytest.raises(ValueError, match="missing columns"):
        T.read_tsv(spark, path, required=("other",))


def test_empty_lists_are_empty_fields(spark, tmp_path):
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-1"), ("S1-1", "S2-1")], "source1_entity_id string, candidate_entity_id string")
    T.write_matches(s1, pairs, str(tmp_path / "out"))
    lines = sorted({line for p in (tmp_path / "out").glob("part-*") for line in p.read_text().splitlines()})
    assert lines == ["S1-1\tS2-1,S3-1", "S1-2\t", "source1_entity_id\tmatched_entity_ids"]
    T.write_matches(s1, pairs, str(tmp_path / "one.tsv"), single_file=True)
    assert (tmp_path / "one.tsv").read_text() == "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S3-1\nS1-2\t\n"
    with pytest.raises(ValueError, match="prefix"):
        T.write_matches(s1, pairs.selectExpr("source1_entity_id", "'S1-9' AS candidate_entity_id"), str(tmp_path / "bad"))


def test_experiment_log(spark, tmp_path):
    path = str(tmp_path / "log")
    assert E.load_experiments(spark, path).isEmpty()
    base = {"blocking_version": "a", "feature_version": "b", "model_version": "c", "threshold": 0.5, "rel_margin": 1.0}
    E.log_experiment(spark, path, **base, macro_f05=0.61234)
    best = E.log_experiment(spark, path, **base, macro_f05=0.9, notes="x, y")
    log = E.load_experiments(spark, path)
    assert log.count() == 2 and {r.macro_f05 for r in log.collect()} == {"0.6123", "0.9"}
    assert E.best_experiment(log).first().experiment_id == best
    assert E.best_experiment(log, "leaderboard_score").isEmpty()


def test_file_rules(spark, tmp_path):
    folder = tmp_path / "test"
    for n in (1, 2, 3):
        write(folder / f"test_source{n}.tsv", HEAD + f"S{n}-1\tx\t\tUS\n")
    good = write(tmp_path / "m.tsv", "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\n")
    cand = write(tmp_path / "c.tsv", "source1_entity_id\tcandidate_entity_ids\nS1-1\tS3-1\n")
    errors, warnings = V.check_outputs(spark, good, cand, str(folder), check_ids=True)
    assert errors == [] and any("outside their candidates" in w for w in warnings)
    comma = write(tmp_path / "comma.tsv", "source1_entity_id,matched_entity_ids\n")
    header = write(tmp_path / "h.tsv", "a\tb\n")
    latin = str(tmp_path / "latin.tsv")
    with open(latin, "wb") as out:
        out.write("source1_entity_id\tmatched_entity_ids\nS1-1\tS2-é\n".encode("latin-1"))
    rows = write(tmp_path / "r.tsv", "source1_entity_id\tmatched_entity_ids\nbroken\nS1-2\tS2-77\n")
    for path, part in ((comma, "not commas"), (header, "instead of"), (str(tmp_path / "no.tsv"), "absent"), (write(tmp_path / "e.tsv", ""), "no header"), (latin, "not UTF-8")):
        assert part in V.check_outputs(spark, path, None, str(folder))[0][0]
    text = " ".join(V.check_outputs(spark, rows, None, str(folder), check_ids=True)[0])
    assert all(x in text for x in ("one_field", "missing_s1", "extra_s1", "unknown_id"))


def test_config_ranges():
    with pytest.raises(ValueError):
        pipeline.Config(threshold=1.5)
    with pytest.raises(ValueError):
        pipeline.Config(rel_margin=-1)


def test_train_and_predict(spark, tmp_path):
    import random

    random.seed(2)
    words = "alpha bravo cedar delta ember falcon grove harbor iris jade karma lotus maple nova opal pine quartz river stone tulip".split()
    files = {f"{split}{n}": HEAD for split in ("train", "test") for n in (1, 2, 3)}
    truth = "source1_entity_id\tmatched_entity_ids\n"
    for i in range(60):
        name = " ".join(random.sample(words, 3))
        address = f"{i} {random.choice(words)} St {10000 + i}"
        for split in ("train", "test"):
            files[split + "1"] += f"S1-{i}\t{name}\t{address}\tUS\n"
            if i % 3:
                files[split + "2"] += f"S2-{i}\t{name} Inc\t{address}\tUS\n"
            files[split + "3"] += f"S3-{i}\t{' '.join(random.sample(words, 3))}\t{i} other Rd {20000 + i}\tUS\n"
        truth += f"S1-{i}\t{f'S2-{i}' if i % 3 else ''}\n"
    for key, text in files.items():
        write(tmp_path / key[:-1] / f"{key[:-1]}_source{key[-1]}.tsv", text)
    write(tmp_path / "train/train_ground_truth.tsv", truth)
    config = pipeline.Config(str(tmp_path / "train"), str(tmp_path / "test"), str(tmp_path / "out"), trees=3, n_splits=2, scripts="latin", single_file=True)
    result = pipeline.run_training(spark, config)
    assert result["macro_f05"] > 0.8 and set(result["average_precision"]) == {"gbt", "forest", "linear"}
    assert E.load_experiments(spark, f"{config.output_dir}/experiments").count() == 1
    summary = pipeline.run_pipeline(spark, config)
    assert summary["n_s1"] == 60 and summary["n_matches"] > 20
    errors, _ = V.check_outputs(spark, config.matches, config.candidates, config.test_dir, check_ids=True)
    assert errors == [] and (tmp_path / "out/matching_results.tsv").is_file()
    pipeline.run_blocking(spark, config.train_dir, "train", str(tmp_path / "blocked.tsv"), limit=5, config=config)
    assert len((tmp_path / "blocked.tsv").read_text().splitlines()) == 6
    report = pipeline.recall_report(spark, config.test_dir, "test", config.candidates, f"{config.train_dir}/train_ground_truth.tsv")
    assert report["true_pairs"] == 40 and report["pair_recall"] > 0.9
    with pytest.raises(T.SourceError, match="train first"):
        pipeline.run_pipeline(spark, pipeline.Config(config.train_dir, config.test_dir, str(tmp_path / "other")))


def test_zip(tmp_path):
    write(tmp_path / "code/a.py", "1")
    write(tmp_path / "code/__pycache__/a.pyc", "1")
    out = write(tmp_path / "m.tsv", "x")
    made = packaging.build_zip(str(tmp_path / "z.zip"), str(tmp_path / "code"), {"output/m.tsv": out}, ("a.py",))
    assert sorted(zipfile.ZipFile(made).namelist()) == ["code/a.py", "output/m.tsv"]
    with pytest.raises(packaging.PackagingError):
        packaging.build_zip(str(tmp_path / "y.zip"), str(tmp_path / "code"), {}, ("requirements.txt",))
    with pytest.raises(packaging.PackagingError, match="broken"):
        packaging.build_zip(str(tmp_path / "y.zip"), str(tmp_path / "code"), {}, check=lambda: (["broken"], []))


def test_api_with_own_column_names(spark):
    from linkweave.plans import api

    names = {"entity_id": "key", "business_name": "firm", "business_address": "place", "country": "land"}
    make = lambda *rows: spark.createDataFrame(rows, "key string, firm string, place string, land string")
    s1 = make(("S1-1", "Größe & Söhne GmbH", "1 Oak St 12345", "DE"))
    s2 = make(("S2-1", "Grosse and Sohne", "1 Oak Street 12345", "DE"), ("S2-2", None, None, None))
    s3 = make(("S3-1", "Other", "2 Elm St 54321", "DE"))
    pairs = api.generate_candidates(s1, s2, s3, columns=names)
    assert [tuple(r)[:3] for r in pairs.collect()] == [("S1-1", "S2-1", "name_prefix")]
    row = api.build_features(pairs.withColumnRenamed("source1_entity_id", "s1_id"), s1, s2, s3, columns=names).first()
    assert row.feat_name_jaccard == 1.0 and row.feat_pincode_match == 1 and row.feat_addr_levenshtein == 1.0


def test_package_command(tmp_path, monkeypatch, capsys):
    write(tmp_path / "code/a.py", "1")
    m, c = write(tmp_path / "m.tsv", "x"), write(tmp_path / "c.tsv", "x")
    assert packaging.main([str(tmp_path / "z.zip"), "--code-dir", str(tmp_path / "code"), "--matching", m, "--candidates", c]) == 0
    assert "z.zip" in capsys.readouterr().out
