"""quarry — corpus discovery and evidence mining as Spark DataFrame operators.

DataFrame-in / DataFrame-out operators over *landed* data: keyword lines,
search responses, page copies, JATS full text, deposit API responses and
file-response metadata.  Nothing here fetches from the network.

Layout
------
functions/  Column expressions (scalars, lexicon matching, query variants)
operators/  DataFrame -> DataFrame operators (score, keep-best, parse pages,
            copy choice, deposits, figures, records, reports)
sources/    readers, landed-response normalisers and sinks
plans/      end-to-end discover / extract plans and the query catalog
streaming/  the stateless scoring ops applied to a streaming DataFrame
"""

__version__ = "0.1.0"
