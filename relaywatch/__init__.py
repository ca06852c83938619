"""relaywatch: delivery-reliability and incident analytics on Spark.

Every operator takes and returns DataFrames; nothing is collected to the
driver inside an operator. Sub-packages:

- ``sources``   readers and writers (topic records, JSON lines, corpus, history)
- ``functions`` column expressions (tokenise, percentages, parsing, classify)
- ``operators`` DataFrame operators (reliability, KPIs, search, history, demand)
- ``plans``     registered queries over the driver tables and their SQL twins
- ``streaming`` Structured Streaming versions whose final state equals batch
"""

from relaywatch.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
