from crestline.sources.readers import get_reader, load_inputs, open_source, register_reader

__all__ = ["get_reader", "load_inputs", "open_source", "register_reader"]
