"""The reference's only "stream": finite tables replayed as training batches.

It has no event time, watermark or late data (see README), so there is
no Structured Streaming query here; batches are a static plan
``(epoch, batch_order, batch_id, id)`` computed by ordinary jobs.
"""
