from types import SimpleNamespace

import pytest

from barsignal.session import SESSION_CONF, configure, work_dir


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host:6443", "local[2]", "local-cluster[2,1,1024]"])
def test_configure_sets_the_same_conf_on_every_master(master):
    seen = {}
    stub = SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(set=seen.__setitem__))
    assert configure(stub) is stub
    assert seen == SESSION_CONF


@pytest.mark.parametrize(("master", "conf", "root"), [
    ("spark://a:7077", {"spark.sql.warehouse.dir": "file:/home/me/warehouse"}, None),
    ("yarn", {"spark.sql.warehouse.dir": "/home/me/warehouse"}, None),
    ("yarn", {"spark.sql.warehouse.dir": "s3a://lake/warehouse"}, "s3a://lake/warehouse"),
    ("yarn", {"spark.sql.warehouse.dir": "file:/x", "spark.checkpoint.dir": "file:///shared"}, "file:///shared"),
    ("local[4]", {"spark.sql.warehouse.dir": "file:/x"}, "file:/x"),
])
def test_a_cluster_needs_a_shared_folder(master, conf, root):
    stub = SimpleNamespace(conf={"spark.master": master, **conf})
    if root is None:
        with pytest.raises(ValueError):
            work_dir(stub, "name")
    else:
        assert work_dir(stub, "name").startswith(f"{root}/name-")
