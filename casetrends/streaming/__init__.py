from casetrends.streaming.publish import publish_stream, published

__all__ = ["publish_stream", "published"]
