"""The command-line entry maps flags onto the run configuration (no Spark needed)."""

from ledgerscope.__main__ import parse


def test_flags_map_to_config_and_column_names():
    cfg = parse(["--data-dir", "s3a://b/x", "--cutoff-date", "2024-05-01", "--valid-frac", "0.3",
                 "--reuse-feature-store", "--txn-amount-col", "AMOUNT"])
    assert cfg.data_dir == "s3a://b/x" and cfg.cutoff_date == "2024-05-01" and cfg.valid_frac == 0.3
    assert cfg.reuse_feature_store is True
    assert cfg.columns.txn_amount_col == "AMOUNT" and cfg.columns.src_account_col == "SRC_ACCOUNT"


def test_defaults():
    cfg = parse([])
    assert cfg.reuse_feature_store is False and cfg.train_sample_frac == 1.0 and cfg.random_seed == 42


def test_a_cluster_run_does_not_start_at_spark_s_200_partitions():
    from ledgerscope.session import initial_partitions

    assert parse([]).shuffle_partitions == 800 and parse(["--shuffle-partitions", "40000"]).shuffle_partitions == 40_000
    assert initial_partitions(10 << 40) == 40_960 and initial_partitions(1) == 800


def test_no_machine_local_checkpoints_on_a_cluster():
    import pytest

    from ledgerscope.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
