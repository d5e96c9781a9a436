"""Staged folders: made under the checkpoint root, deleted at the end of their scope."""

import threading
from pathlib import Path

import pytest

from chaintally.session import checkpoint_root, delete_folders, staged_scope, staging_path


def there(path):
    return Path(path.removeprefix("file:")).exists()


def staged(spark, name, **options):
    path = staging_path(spark, name, **options)
    spark.range(3).write.parquet(path)
    return path


def test_scope_deletes_what_was_staged_within(spark):
    before = staged(spark, "before")
    result = staging_path(spark, "result")
    with staged_scope(spark):
        inner = staged(spark, "inner")
        kept = staged(spark, "kept", kept=True)
        never_written = staging_path(spark, "never")
        spark.read.parquet(inner).write.parquet(result)
    assert [there(p) for p in (before, result, inner, kept, never_written)] == [True, True, False, True, False]
    assert spark.read.parquet(result).count() == 3 and result.startswith(checkpoint_root(spark))
    after = staged(spark, "after")
    assert there(after)
    delete_folders(spark, [before, result, kept, after, never_written])
    assert not any(map(there, (before, result, kept, after)))


def test_scope_deletes_after_a_failure_and_nests(spark):
    with pytest.raises(ValueError):
        with staged_scope(spark):
            outer = staged(spark, "outer")
            with staged_scope(spark):
                inner = staged(spark, "inner")
            assert there(outer) and not there(inner)
            later = staged(spark, "later")
            raise ValueError
    assert not there(outer) and not there(later)


def test_other_threads_keep_their_folders(spark):
    found = []
    with staged_scope(spark):
        thread = threading.Thread(target=lambda: found.append(staged(spark, "thread")))
        thread.start()
        thread.join()
    assert there(found[0])
