import os
from types import SimpleNamespace

import pytest

from examloom.session import fresh_path, shared_dir


def fake(master, setting=None, app="app-1"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: setting or default),
        sparkContext=SimpleNamespace(master=master, applicationId=app),
    )


def test_the_setting_names_the_shared_folder(spark):
    assert shared_dir(fake("yarn", "s3://b/work/")) == "s3://b/work"
    assert fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,1024]", "spark://h:7077", "k8s://x"])
def test_a_cluster_without_the_setting_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake(master))


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_one_process_has_a_folder_of_its_own_for_the_application(master):
    first = shared_dir(fake(master, app=master))
    assert os.path.isdir(first) and shared_dir(fake(master, app=master)) == first
    assert shared_dir(fake(master, app=master + "2")) != first
