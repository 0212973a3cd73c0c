import math


from corpusprep.operators.runlog import (
    argmax_prediction,
    best_so_far,
    cadence,
    checkpoint_ring,
    completed_steps,
    epoch_summary,
    eval_loss,
    final_best,
    next_token_accuracy,
    perplexity,
    resume_point,
    running_train_loss,
)


def _train_log(spark, accum=2, per_epoch=4, epochs=2):
    rows = []
    for step in range(per_epoch * epochs):
        in_epoch = step % per_epoch
        sync = (in_epoch + 1) % accum == 0 or in_epoch == per_epoch - 1
        rows.append(("r", step // per_epoch, step, float(step + 1), sync))
    return spark.createDataFrame(rows, "run string, epoch int, micro_step long, loss double, sync boolean")


def test_completed_steps_and_running_loss(spark):
    log = _train_log(spark)
    cs = {r.micro_step: r.completed_steps for r in completed_steps(log, chunk_size=3).collect()}
    assert [cs[i] for i in range(8)] == [0, 1, 1, 2, 2, 3, 3, 4]
    rl = {r.micro_step: r for r in running_train_loss(log, chunk_size=3).collect()}
    assert rl[0].train_loss is None                        # no step complete yet
    assert rl[5].epoch_loss_sum == 6 + 5                   # epoch 1 restarts the sum
    assert rl[5].train_loss == (6 + 5) / 3                 # ... divided by steps of all epochs
    ep = {r.micro_step: r for r in running_train_loss(log, denominator="epoch", chunk_size=3).collect()}
    assert ep[5].train_loss == (6 + 5) / 1


def test_cadence_once_per_step(spark):
    cs = completed_steps(_train_log(spark))
    got = sorted((r.completed_steps, r.micro_step) for r in cadence(cs, 2).collect())
    assert got == [(2, 3), (4, 7)]


def test_eval_loss_perplexity_overflow(spark):
    rows = [("r", 0, 1, 0, 2, 1.0), ("r", 0, 1, 1, 1, 4.0), ("r", 0, 2, 0, 1, 710.0)]
    df = spark.createDataFrame(rows, "run string, epoch int, completed_steps long, batch_no long, n long, loss double")
    e = {r.completed_steps: r for r in eval_loss(df).collect()}
    assert e[1].eval_loss == 2.0 and abs(e[1].perplexity - math.exp(2.0)) < 1e-12
    assert e[2].perplexity == float("inf")


def test_best_so_far_ties_and_nan(spark):
    rows = [("r", 1, 3.0), ("r", 2, 2.0), ("r", 3, 2.0), ("r", 4, float("nan")), ("r", 5, 1.5)]
    df = spark.createDataFrame(rows, "run string, completed_steps long, eval_loss double")
    b = {r.completed_steps: r.is_best for r in best_so_far(df, chunk_size=2).collect()}
    assert b == {1: True, 2: True, 3: False, 4: False, 5: True}
    fb = final_best(df.where("completed_steps < 5")).first()
    assert (fb.best_loss, fb.best_step) == (2.0, 2)


def test_checkpoint_ring_fixture(spark):
    saves = spark.createDataFrame([("r", s) for s in range(10, 70, 10)], "run string, completed_steps long")
    slots = sorted((r.slot, r.completed_steps) for r in checkpoint_ring(saves, 10).collect())
    assert sorted(s for _, s in slots) == [20, 30, 40, 50, 60]
    assert dict(slots)[1] == 60 and dict(slots)[0] == 50


def test_epoch_summary_and_resume(spark):
    ev = spark.createDataFrame([("r", 0, 5, 2.0), ("r", 0, 8, 1.0), ("r", 1, 12, 0.5)],
                               "run string, epoch int, completed_steps long, eval_loss double")
    s = {r.epoch: r for r in epoch_summary(ev).collect()}
    assert s[0].eval_loss == 1.0 and not s[0].is_final and s[1].is_final
    names = spark.createDataFrame([("epoch_3",), ("step_40",), ("last_step_2",), ("junk",)], "name string")
    r = {x.name: x for x in resume_point(names, accum=4, batches_per_epoch=30, updates_per_epoch=8).collect()}
    assert (r["epoch_3"].start_epoch, r["epoch_3"].completed_steps, r["epoch_3"].skip_batches) == (4, 32, 0)
    assert (r["step_40"].start_epoch, r["step_40"].completed_steps, r["step_40"].skip_batches) == (5, 40, 10)
    assert r["last_step_2"].reason and r["junk"].start_epoch is None


def test_argmax_and_accuracy(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],)], "logits array<float>")
    assert argmax_prediction(df).first().prediction == 1
    seq = spark.createDataFrame([([1, 2, 3, 4], [2, 3, 0, 9]), ([5], [5])], "labels array<int>, preds array<int>")
    r = next_token_accuracy(seq).first()
    assert (r.correct, r.compared) == (2, 3)
    assert perplexity is not None


def test_eval_loss_ignores_batches_without_loss(spark):
    rows = [("r", 0, 1, 0, 2, 1.0), ("r", 0, 1, 1, 5, None), ("r", 0, 1, 2, 1, 4.0)]
    df = spark.createDataFrame(rows, "run string, epoch int, completed_steps long, batch_no long, n long, loss double")
    r = eval_loss(df).first()
    assert (r.n_examples, r.eval_loss) == (3, 2.0)
