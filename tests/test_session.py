from unittest import mock

import pytest
from records import line

from paytally import __main__ as command_line
from paytally.session import scratch_path, settings_for, shared_dir


def context(setting, master="local[2]", current=None):
    spark = mock.MagicMock()
    spark.sparkContext.getConf().get.return_value = setting
    spark.sparkContext.getCheckpointDir.return_value = current
    spark.sparkContext.master = master
    return spark


def test_shared_folder_comes_from_the_setting():
    assert shared_dir(context("s3a://shared/ck/")) == "s3a://shared/ck"
    assert shared_dir(context(None, current="hdfs:/ck")) == "hdfs:/ck"
    assert scratch_path(context("s3a://shared"), "x").startswith("s3a://shared/paytally/x-")


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(RuntimeError):
        shared_dir(context(None, master="spark://head:7077"))


def test_a_local_session_sets_its_own():
    spark = context(None)
    shared_dir(spark)
    spark.sparkContext.setCheckpointDir.assert_called_once()


def test_command_line(spark, tmp_path, capsys):
    folder = tmp_path / "raw" / "2017_01"
    folder.mkdir(parents=True)
    (folder / "payments_2017_01_05.json").write_text(line() + "\n" + line("9", "7"))
    common = ["--warehouse", str(tmp_path / "house"), "--database", "cli_test"]
    command_line.main([*common, "load", str(tmp_path / "raw"), "2017", "1", "5"])
    assert "'pair_activity': 1" in capsys.readouterr().out
    command_line.main([*common, "load-file", str(folder), "--tables", "users", "sender_activity"])
    assert "{'users': 0, 'sender_activity': 0}" in capsys.readouterr().out
    command_line.main([*common, "report", "active_senders", "2017-01-05", "10"])
    assert "Ann Lee" in capsys.readouterr().out
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(line("1", "2"))
    paths = [str(landing), str(tmp_path / "done"), str(tmp_path / "ck")]
    command_line.main([*common, "ingest", *paths])
    assert "'users': 2" in capsys.readouterr().out
    command_line.main([*common, "clean"])
    assert capsys.readouterr().out.strip() == "8"  # the day of each metric and its best rows
    spark.sql("DROP DATABASE cli_test CASCADE")
    with pytest.raises(SystemExit):
        command_line.main([*common, "report", "lurkers", "2017-01-05", "10"])


def test_partition_sizes_follow_the_input():
    def sizes(input_bytes):
        found = settings_for(input_bytes)
        split = int(found["spark.sql.files.maxPartitionBytes"])
        return split, int(found["spark.sql.shuffle.partitions"])

    assert sizes(10**9) == (128 << 20, 200)
    split, partitions = sizes(100 * 10**12)
    assert 100 * 10**12 / split <= 200_000
    assert 6 * 10**12 / partitions <= 128 << 20
