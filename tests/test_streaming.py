from starledger.session import scratch_path
from starledger.streaming import ingest_new_files
from tests.fixtures import write_landing


def test_stream_ingests_only_new_files(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"), years=(2019,))
    silver = scratch_path(spark, "silver-stream")
    ckpt = scratch_path(spark, "stream-ckpt")
    ingest_new_files(spark, landing, silver, "assistance", checkpoint=ckpt)
    first = spark.read.parquet(f"{silver}/assistance")  # the landed files repeat one row; every batch is distinct
    assert first.count() == 3 and {r[0] for r in first.select("action_date_fiscal_year").distinct().collect()} == {2019}
    ingest_new_files(spark, landing, silver, "assistance", checkpoint=ckpt)      # nothing new: unchanged
    assert spark.read.parquet(f"{silver}/assistance").count() == 3
    write_landing(str(tmp_path / "landing"), years=(2020,))
    ingest_new_files(spark, landing, silver, "assistance", checkpoint=ckpt)
    assert spark.read.parquet(f"{silver}/assistance").count() == 5


def test_stream_one_file_per_batch_gives_same_silver(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"), years=(2019, 2020))
    silver = scratch_path(spark, "silver-stream-batches")
    ingest_new_files(spark, landing, silver, "assistance", checkpoint=scratch_path(spark, "ckpt"),
                     max_files_per_trigger=1)
    assert spark.read.parquet(f"{silver}/assistance").count() == 5


def test_two_targets_of_one_landing_folder_and_duplicates_over_files(spark, tmp_path):
    landing = write_landing(str(tmp_path / "landing"), years=(2019,))
    folder = tmp_path / "landing" / "assistance"
    for f in list(folder.iterdir()):
        if f.suffix == ".csv":
            (folder / f"copy_{f.name}").write_text(f.read_text())
    targets = [scratch_path(spark, f"silver-{n}") for n in "ab"]
    ingest_new_files(spark, landing, targets[0], "assistance")
    ingest_new_files(spark, landing, targets[1], "assistance", max_files_per_trigger=1)
    a, b = (sorted(map(str, spark.read.parquet(f"{t}/assistance").collect())) for t in targets)
    assert a == b and len(a) == len(set(a)) == 3
