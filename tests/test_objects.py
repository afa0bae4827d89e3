"""Backup and restore by object."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from pulsegrid.operators import recovery_point
from pulsegrid.sources import backup_objects, compare_objects, object_manifest, restore_objects


def put(root, **objects):
    for name, data in objects.items():
        path = root / name.replace("__", "/")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def tree(root):
    return {os.path.relpath(os.path.join(d, f), root): open(os.path.join(d, f), "rb").read()
            for d, _, files in os.walk(root) for f in files if not f.startswith(".")}


def states(spark, root, store, version):
    return {r["path"]: r["state"] for r in compare_objects(spark, str(root), str(store), version).collect()}


def test_hashes_are_those_of_the_bytes(spark, tmp_path):
    root = tmp_path / "zone with space"
    put(root, a=b"one", b__c=b"", b__d=bytes(range(256)) * 50_000)
    found = {r["path"]: (r["bytes"], r["sha256"]) for r in object_manifest(spark, str(root)).collect()}
    assert found == {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in tree(root).items() if d}


def test_only_new_and_changed_objects_are_copied(spark, tmp_path):
    root, store = tmp_path / "zone", tmp_path / "store"
    put(root, a=b"one", b__c=b"two", b__d=b"two")
    first = {r["path"]: r["copied"] for r in backup_objects(spark, str(root), str(store), "v1").collect()}
    assert set(first) == {"a", "b/c", "b/d"} and first["a"]
    put(root, a=b"ONE", e=b"two")
    second = {r["path"]: r["copied"] for r in backup_objects(spark, str(root), str(store), "v2", after="v1").collect()}
    assert second == {"a": True, "b/c": False, "b/d": False, "e": False}       # e holds bytes the store has
    assert sorted(tree(store / "objects").values()) == [b"ONE", b"one", b"two"]
    again = backup_objects(spark, str(root), str(store), "v2", after="v1")       # repeated: nothing to write
    assert again.where("copied").count() == 0 and again.count() == 4


def test_restore_drill(spark, tmp_path):
    root, store = tmp_path / "zone", tmp_path / "store"
    put(root, a=b"one", b__c=b"two", b__d=b"three", keep=b"same")
    before = tree(root)
    backup_objects(spark, str(root), str(store), "v1")
    os.remove(root / "a")
    put(root, b__c=b"tw0", new=b"later")
    assert states(spark, root, store, "v1") == {"a": "missing", "b/c": "changed", "b/d": "same", "keep": "same", "new": "unexpected"}
    lost = recovery_point(compare_objects(spark, str(root), str(store), "v1")).first()
    assert (lost["objects_expected"], lost["objects_intact"], lost["objects_lost"], lost["size_lost"]) == (4, 2, 2, 6)
    restored = restore_objects(spark, str(root), str(store), "v1")
    assert sorted((r["path"], r["bytes"]) for r in restored.collect()) == [("a", 3), ("b/c", 3)]
    assert tree(root) == before | {"new": b"later"}
    assert restore_objects(spark, str(root), str(store), "v1").count() == 0


def test_damaged_store_is_noticed(spark, tmp_path):
    root, store = tmp_path / "zone", tmp_path / "store"
    put(root, a=b"one")
    backup_objects(spark, str(root), str(store), "v1")
    sha256 = hashlib.sha256(b"one").hexdigest()
    (store / "objects" / sha256[:2] / sha256).write_bytes(b"0ne")
    os.remove(root / "a")
    with pytest.raises(Exception, match="DamagedObject"):
        restore_objects(spark, str(root), str(store), "v1")
    assert tree(root) == {}


def test_empty_zone(spark, tmp_path):
    root, store = tmp_path / "zone", tmp_path / "store"
    root.mkdir()
    assert backup_objects(spark, str(root), str(store), "v1").count() == 0
    assert recovery_point(compare_objects(spark, str(root), str(store), "v1")).select(F.sum("objects_lost")).first()[0] == 0
