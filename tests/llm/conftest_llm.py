"""What the tests of this folder share."""

import os

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def same(found, expected):
    """Equal rows, each as often."""
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
