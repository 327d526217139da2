"""Every operator of the inventory is exercised by a registered query or by a named test."""

from __future__ import annotations

import importlib

from faremill.registry import registered

INVENTORY = {
    "S": 21, "K": 17, "P": 8, "F": 11, "J": 9, "A": 20, "W": 5, "O": 4, "U": 4, "X": 23, "R": 3,
    "T": 8, "D": 1, "Q": 14,
}

# operators without a query of their own, and the test that covers them
BY_TEST = {
    "S7": "test_landing.test_paths_are_uris",
    "S18": "test_streaming.test_generated_events",
    "K6": "test_writers.test_connector_write",
    "K15": "test_streaming.test_jdbc_writer_options",
    "K16": "test_streaming.test_console_writer",
    "D1": "test_functions.test_base_code_equals_a_python_version_and_stays_in_the_jvm",
}


def test_nothing_is_missing():
    covered = {i for q in registered().values() for i in q.covers} | set(BY_TEST)
    wanted = {f"{letter}{n}" for letter, count in INVENTORY.items() for n in range(1, count + 1)}
    assert wanted - covered == set()
    assert covered - wanted == set()


def test_named_tests_exist():
    for name in BY_TEST.values():
        module, test = name.split(".")
        assert hasattr(importlib.import_module(f"tests.{module}"), test), name
