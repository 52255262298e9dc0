"""Tests of the llm subpackage; deleted together with it."""
