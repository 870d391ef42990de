"""Every operator as a query on the test tables, with the SQL that must give the same rows."""

from forgemart.checks import chain, expressions, layers, loads, marts, streams

CASES = {**marts.CASES, **expressions.CASES, **layers.CASES, **loads.CASES, **streams.CASES, **chain.CASES}
