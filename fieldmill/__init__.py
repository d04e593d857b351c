"""fieldmill: DataFrame operators that mill messy delimited, JSON and XML fields into typed tables.

Sub-packages
------------
``sources``    readers, table writers and the shared working folder
``functions``  expressions: ``Column -> Column``
``operators``  table steps: ``DataFrame -> DataFrame``; they chain with ``DataFrame.transform``
``streaming``  file streams and the bronze / silver / gold steps
``plans``      whole workloads composed from the above, and the registered queries
"""
