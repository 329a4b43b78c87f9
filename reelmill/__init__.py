"""Set-based Spark jobs for a media-transcript workflow.

Feeds, caption responses and summarisation results arrive as landed files; the
package turns them into state changes for whole batches of episodes and answers
queue, list and report queries over that state. Everything is DataFrame in,
DataFrame out; clocks (``as_of`` / ``now``) are always arguments.
"""
