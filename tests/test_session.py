"""The shared folder, and broadcasts behind a check of their size."""

from types import SimpleNamespace

import pytest

from clicksieve import session


def broadcasts(df):
    return "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()


def test_small_side(spark):
    df = session.settle(spark.range(10).selectExpr("id", "repeat('é', 50) as name", "cast(null as string) as none"))
    assert session.measured_bytes(df) == 10 * (16 + 116 + 16)
    assert session.measured_bytes(df.limit(0)) == 0
    assert broadcasts(session.small_side(df, 1480))
    assert not broadcasts(session.small_side(df, 1479))


def test_shared_folder_is_the_one_the_cluster_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_run_folder(spark, "x") != session.new_run_folder(spark, "x")


def test_a_cluster_has_to_name_its_folder():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    unnamed = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(unnamed)


@pytest.mark.parametrize("folder", ["/tmp/shared", "relative"])
def test_a_cluster_has_to_name_a_shared_file_system(folder):
    hadoop = SimpleNamespace(get=lambda key: "file:///")
    context = SimpleNamespace(
        master="spark://host", getCheckpointDir=lambda: None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop)
    )
    local = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: folder))
    with pytest.raises(RuntimeError, match="local to each machine"):
        session.shared_folder(local)


@pytest.mark.parametrize("master", ["local-cluster[3,2,1800]", "spark://localhost:7077", "spark://127.0.0.1:7077"])
@pytest.mark.parametrize("folder", ["/tmp/shared", "relative"])
def test_processes_of_one_machine_share_a_local_folder(spark, tmp_path, monkeypatch, master, folder):
    monkeypatch.chdir(tmp_path)
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: "set", _jsc=spark.sparkContext._jsc
    )
    cluster = SimpleNamespace(
        sparkContext=context, _jsc=spark._jsc, _jvm=spark._jvm, conf=SimpleNamespace(get=lambda key, default: folder)
    )
    found = session.shared_folder(cluster)
    assert found.startswith("file:/") and found.endswith(folder)


def test_another_host_is_another_machine():
    hadoop = SimpleNamespace(get=lambda key: "file:///")
    for master in ("spark://localhost.example.org:7077", "spark://127a:7077", "yarn", "k8s://host"):
        context = SimpleNamespace(
            master=master, getCheckpointDir=lambda: None, _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop)
        )
        local = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: "/tmp/shared"))
        with pytest.raises(RuntimeError, match="local to each machine"):
            session.shared_folder(local)
