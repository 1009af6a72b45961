"""Tests of the training-data operators; a package, so that its conftest stands beside the other one."""
