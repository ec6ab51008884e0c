"""Operators for text and entity data of language-model pipelines. Nothing outside this subpackage imports it."""
