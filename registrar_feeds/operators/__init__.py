"""DataFrame -> DataFrame operators the feeds are composed of."""
