from .oracles import oracle_sql
from .registry import entry, queries
