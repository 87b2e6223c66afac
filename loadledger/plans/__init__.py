"""End-to-end flows. Only here, in sources and in streaming do actions run."""
