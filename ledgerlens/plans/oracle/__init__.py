"""DuckDB SQL for every catalogue key (the correctness gate).

Each statement answers its question from the adapters' tables, written from the question and
its rules (filtered aggregates, list functions, generated series); neither side is derived
from the other.
"""
