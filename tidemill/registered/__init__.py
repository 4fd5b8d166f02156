"""All registered queries with their SQL twins."""

from tidemill.registered import batch, indicators, posts, prices, readings, streams

QUERIES = {
    name: query
    for module in (readings, batch, posts, indicators, prices, streams)
    for name, query in module.QUERIES.items()
}
